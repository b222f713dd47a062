"""Delimited files with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyfield.sources.schemas import SCHEMAS, SEPARATORS


def read_delimited(
    spark: SparkSession, path: str, schema: str, sep: str | None = None, header: bool = True,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Read with a declared schema: a DDL string, or a name from the schema registry.

    A field that does not parse becomes NULL, or is an error with ``mode="FAILFAST"``.
    """
    ddl = SCHEMAS.get(schema, schema)
    sep = sep or SEPARATORS.get(schema, ",")
    return spark.read.schema(ddl).option("sep", sep).option("header", header).option("mode", mode).csv(path)


def read_delimited_inferred(
    spark: SparkSession, path: str, sep: str = ",", header: bool = True, sampling_ratio: float = 1.0
) -> DataFrame:
    """Read with inferred types. Inference reads ``sampling_ratio`` of the lines once more."""
    return (
        spark.read.option("sep", sep).option("header", header)
        .option("inferSchema", True).option("samplingRatio", sampling_ratio).csv(path)
    )


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> str:
    """Write one headed file per partition; returns the path."""
    df.write.option("sep", sep).option("header", True).csv(path)
    return path
