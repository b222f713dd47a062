"""Grouped summaries. The same functions run on a stream and on a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.rounding import exact_sum, round_stable


def type_summary(df: DataFrame, key: str, amount: str, digits: int = 2) -> DataFrame:
    """(key, n, avg_amount, min_amount, max_amount)."""
    return df.groupBy(key).agg(
        F.count("*").alias("n"),
        round_stable(F.avg(amount), digits).alias("avg_amount"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
    )


def filtered_totals(
    df: DataFrame, kind: str, wanted: str, key: str, amount: str, digits: int = 2
) -> DataFrame:
    """(key, n, total_amount, avg_amount) over the rows of one kind."""
    return df.filter(F.col(kind) == wanted).groupBy(key).agg(
        F.count("*").alias("n"),
        exact_sum(amount).alias("total_amount"),
        round_stable(F.avg(amount), digits).alias("avg_amount"),
    )


def by_count(df: DataFrame, key: str) -> DataFrame:
    """Order by falling count. On a stream this is allowed in complete mode only."""
    return df.orderBy(F.col("n").desc(), key)
