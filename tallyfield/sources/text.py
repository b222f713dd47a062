"""Text files, one row per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``line STRING``. Large uncompressed files are split between tasks."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def write_lines(df: DataFrame, path: str, column: str = "line") -> str:
    """Write one column as text lines; returns the path."""
    df.select(column).write.text(path)
    return path
