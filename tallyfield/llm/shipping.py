"""The package on every executor."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import tallyfield

_SHIPPED: set[str] = set()
# Bytes of rows that reach a Python worker at once, unless the session names another number.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the session was started.

    Once per application the package's sources go to the executors as a Python file of the job. A
    session that has Spark's default for the size of Arrow batches gets a smaller one: long texts
    would otherwise fill the memory beside the heap.
    """
    key, default, smaller = BATCH_BYTES
    if spark.conf.get(key) == default:
        spark.conf.set(key, smaller)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(tallyfield.__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(root.rglob("*.py")):
            file.write(source, source.relative_to(root.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def shipped(plan: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``plan(spark, ...)`` with the package sent ahead."""
    @functools.wraps(plan)
    def run(spark: SparkSession, *args: object) -> DataFrame:
        ship(spark)
        return plan(spark, *args)
    return run
