"""Where intermediate files go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder path on storage that every executor can reach.

    The cluster names the parent in ``spark.checkpoint.dir``. Only a local session, where driver
    and executors share one machine, may go without it.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        parent = tempfile.mkdtemp(prefix="tallyfield-")
    return f"{parent.rstrip('/')}/tallyfield/{label}-{uuid.uuid4().hex}"
