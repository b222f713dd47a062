"""Streaming file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyfield.sources.delimited import read_delimited_inferred


def borrow_schema(spark: SparkSession, sample_path: str, sep: str = ",") -> StructType:
    """Infer a schema once from a batch sample, for use on the stream.

    The types cover every line of every file of the sample; a sample without rows tells nothing and
    is refused. Files that come later are not known here: read them with ``mode="FAILFAST"`` so that
    a value outside the borrowed types stops the stream instead of turning into NULL.
    """
    sample = read_delimited_inferred(spark, sample_path, sep)
    if sample.isEmpty():
        raise ValueError(f"no rows to infer types from in {sample_path}")
    return sample.schema


def stream_delimited(
    spark: SparkSession, folder: str, schema: StructType | str, sep: str = ",",
    files_per_trigger: int = 1, mode: str = "PERMISSIVE",
) -> DataFrame:
    """Unbounded rows from the headed files of a folder, a few files per micro-batch.

    ``mode`` says what a field that does not parse does: NULL ("PERMISSIVE") or an error
    ("FAILFAST").
    """
    return (
        spark.readStream.schema(schema).option("sep", sep).option("header", True).option("mode", mode)
        .option("maxFilesPerTrigger", files_per_trigger).csv(folder)
    )
