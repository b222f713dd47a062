"""Rows that do not come from files."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyfield.functions.uniform import keyed_uniform


def uniform_values(spark: SparkSession, n: int, seed: int, name: str = "x") -> DataFrame:
    """``n`` seeded uniform values in [0, 1), generated where they are used."""
    return spark.range(n).select(F.rand(seed).alias(name))


def with_uniform(df: DataFrame, seed: int, name: str = "x", keys: Sequence[str] = ()) -> DataFrame:
    """Add a seeded uniform column. Without ``keys`` the values depend on how ``df`` is partitioned."""
    return df.withColumn(name, keyed_uniform(keys, seed) if keys else F.rand(seed))


def local_rows(spark: SparkSession, rows: Sequence[Sequence], ddl: str) -> DataFrame:
    """A small literal table with a declared schema.

    Passed as Arrow data it becomes a local relation of known size: no Python worker reads it,
    and Spark can tell whether it is small enough to broadcast.
    """
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)
    columns = [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)
