"""Parquet tables and reports about whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a table at least one partition per core before work that is heavy per row.

    A table with enough scan partitions for all cores is returned as it is. ``df`` must be a scan or
    a projection of one: its partitions are counted without running anything.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    return df.repartition(cores) if parts < cores else df


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n) for every table, counted in one job."""
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def partition_sizes(df: DataFrame) -> DataFrame:
    """(partition_id, n) as the rows lie now. Empty partitions have no row."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count("*").alias("n"))


def head_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows under a total order, kept per partition before they are merged."""
    return df.orderBy(*order).limit(n)
