"""Grouped and global aggregates.

All but two of them are built-in aggregate functions, so rows are combined on the map side and only one
partial row per key and task is shuffled. A key that holds a large part of all rows costs no more
than any other key. ``numeric_summary`` and ``fit_quality`` run at once, finish on the driver and
return one row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.bins import Bins, bin_label
from tallyfield.functions.rounding import ratio, round_stable
from tallyfield.operators.moments import exact_totals, size_range, squares_around
from tallyfield.sources.generators import local_rows


def count_by(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def grouped_means(
    df: DataFrame, keys: Sequence[str | Column], means: Mapping[str, str], digits: int = 2,
    count_name: str = "n",
) -> DataFrame:
    """Row count and rounded means (new name -> column) per group."""
    averages = [round_stable(F.avg(column), digits).alias(name) for name, column in means.items()]
    return df.groupBy(*keys).agg(F.count("*").alias(count_name), *averages)


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """The first ``k`` rows under ``order``; name enough columns to break every tie."""
    return df.orderBy(*order).limit(k)


def numeric_summary(df: DataFrame, column: str | Column) -> DataFrame:
    """Sum, mean, population standard deviation, minimum and maximum as one row.

    Three passes over one column: its range, its exact sum, its exact squares around the mean. The
    results are those of exact arithmetic on the values, rounded once, under every partitioning. NaN
    makes sum, mean and deviation NaN, an infinity makes the sum infinite and the deviation NaN; in
    minimum and maximum NaN counts as the largest value. Without values all are NULL.
    """
    x = (F.col(column) if isinstance(column, str) else column).cast("double")
    rows = df.select(x.alias("x"))
    x = F.col("x")
    ends = rows.agg(F.min(x).alias("low"), F.max(x).alias("high"), *size_range(x, "x")).first()
    total = exact_totals(rows, {"x": x}, {"x": (ends["x most"] or 0.0, ends["x least"] or 1.0)})["x"]
    spread = None
    if total.n:
        spread = math.nan
        if math.isfinite(total.mean):
            most = max(abs(ends.low - total.mean), abs(ends.high - total.mean))
            squares = squares_around(rows, {"x": (x, total.mean)}, {"x": most})["x"]
            # The mean is a rounded one: what it is off by counts in every square.
            off = total.exact / total.n - Fraction(total.mean)
            spread = math.inf if squares is None else math.sqrt(max(squares / total.n - off * off, 0))
    return local_rows(df.sparkSession, [(total.value, total.mean, spread, ends.low, ends.high)],
                      "total DOUBLE, mean DOUBLE, stdev DOUBLE, minimum DOUBLE, maximum DOUBLE")


def fit_quality(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(n, mean_actual, sse, sst, r2) of predictions as one row; pairs with a NULL side do not count.

    Errors are squared once and added exactly; the spread is taken around the exact mean. So the
    results are the same under every partitioning. A non-finite value makes what it enters NaN.
    """
    rows = df.select(F.col(actual).cast("double").alias("a"), F.col(predicted).cast("double").alias("p"))
    # Incomplete pairs drop out inside the aggregates. A filter would be pushed below the columns
    # that feed it and compute parsed values twice.
    paired = F.when(F.col("p").isNotNull(), F.col("a"))
    error = F.col("a") - F.col("p")
    ends = rows.agg(*size_range(paired, "a"), *size_range(error * error, "e"), F.min(paired).alias("low"),
                    F.max(paired).alias("high")).first()
    totals = exact_totals(rows, {"a": paired, "e": error * error},
                          {name: (ends[f"{name} most"] or 0.0, ends[f"{name} least"] or 1.0) for name in "ae"})
    n, mean = totals["a"].n, totals["a"].mean
    sse, sst = totals["e"].value, None
    if n:
        sst = math.nan
        if math.isfinite(mean):
            most = max(abs(ends.low - mean), abs(ends.high - mean))
            squares = squares_around(rows, {"a": (paired, mean)}, {"a": most})["a"]
            sst = math.nan if squares is None else float(squares)
    r2 = 1.0 - sse / sst if sst else None
    return local_rows(df.sparkSession, [(n, mean, sse, sst, r2)],
                      "n BIGINT, mean_actual DOUBLE, sse DOUBLE, sst DOUBLE, r2 DOUBLE")


def substring_counts(df: DataFrame, column: str, needles: Mapping[str, str]) -> DataFrame:
    """One row with, per new name, the number of values that contain the substring."""
    text = F.col(column)
    return df.agg(*[F.count_if(text.contains(s)).alias(name) for name, s in needles.items()])


def counts_per_bin(df: DataFrame, column: str, bins: Bins, name: str = "bin") -> DataFrame:
    """(bin, n) in one pass over the rows. Values without a bin are left out."""
    labelled = df.select(bin_label(column, bins).alias(name)).filter(F.col(name).isNotNull())
    return count_by(labelled, name)


def means_per_bin(
    df: DataFrame, column: str, bins: Bins, means: Mapping[str, str], digits: int = 2,
    name: str = "bin",
) -> DataFrame:
    return grouped_means(df, [bin_label(column, bins).alias(name)], means, digits)


def histogram(df: DataFrame, column: str, start: float, width: float, buckets: int) -> DataFrame:
    """(bucket, low, high, n) for equal buckets from ``start``; the last one holds its upper edge.

    Values outside the range are not counted; buckets without values have n = 0.
    """
    top = start + width * buckets
    value = F.col(column)
    counted = (
        df.filter((value >= start) & (value <= top))
        .groupBy(
            F.least(F.floor((value - F.lit(start)) / F.lit(width)), F.lit(buckets - 1))
            .cast("bigint").alias("bucket")
        )
        .agg(F.count("*").alias("n"))
    )
    every = df.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    return every.join(counted, "bucket", "left").select(
        "bucket",
        (F.lit(start) + F.col("bucket") * F.lit(width)).alias("low"),
        (F.lit(start) + (F.col("bucket") + 1) * F.lit(width)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def share_of_total(
    counts: DataFrame, total: DataFrame, count_column: str = "n", digits: int = 4,
    name: str = "share",
) -> DataFrame:
    """Add each count's share of ``total``, a one-row one-column DataFrame.

    The total is a scalar subquery of the same plan: no window over all groups in one task, no
    driver round trip between two jobs.
    """
    return counts.withColumn(name, ratio(F.col(count_column), total.scalar(), digits))


def class_share(df: DataFrame, *keys: str, digits: int = 4) -> DataFrame:
    """(keys, n, share) with the share taken of all rows.

    The total adds up the counts themselves, so their shuffle is reused and ``df`` is read once.
    """
    counts = count_by(df, *keys)
    return share_of_total(counts, counts.agg(F.sum("n")), digits=digits)


def distinct_count_frequency(
    df: DataFrame, entity: str, item: str, items_name: str = "n_items", count_name: str = "n"
) -> DataFrame:
    """How many entities have 1, 2, ... distinct items."""
    per_entity = df.groupBy(entity).agg(F.count_distinct(item).alias(items_name))
    return count_by(per_entity, items_name, name=count_name)


def weighted_mean_by(
    df: DataFrame, keys: Sequence[str], value: str, weight: str, digits: int | None = 2,
    name: str = "mean", ungraded: str = "keep",
) -> DataFrame:
    """sum(value * weight) / sum(weight) per group.

    A row without a value adds nothing to the numerator. Its weight stays in the denominator with
    ``ungraded='keep'`` and leaves it with ``'exclude'``. A group without any value, or whose
    weights sum to zero, has a NULL mean.
    """
    if ungraded not in ("keep", "exclude"):
        raise ValueError("ungraded must be 'keep' or 'exclude'")
    weights = F.col(weight)
    if ungraded == "exclude":
        weights = F.when(F.col(value).isNotNull(), weights)
    mean = ratio(F.sum(F.col(value) * F.col(weight)), F.sum(weights), digits)
    return df.groupBy(*keys).agg(mean.alias(name))


def conditional_shares(
    df: DataFrame, keys: Sequence[str], column: str, values: Mapping[str, str], digits: int = 2,
    count_name: str = "n",
) -> DataFrame:
    """Per group: the number of non-NULL entries and the share of each listed value.

    ``values`` maps a new column name to the value it counts.
    """
    hits = {name: F.count_if(F.col(column) == F.lit(v)) for name, v in values.items()}
    n = F.count(column)
    return df.groupBy(*keys).agg(
        n.alias(count_name), *[ratio(hit, n, digits).alias(name) for name, hit in hits.items()]
    )


def supported_extremes(
    df: DataFrame, support: str, minimum: int, measure: str, tie: str, k: int
) -> DataFrame:
    """The ``k`` lowest and ``k`` highest rows by ``measure`` among those with enough support."""
    kept = df.filter(F.col(support) >= minimum)
    low = top_k(kept, [F.col(measure).asc(), F.col(tie)], k).withColumn("side", F.lit("lowest"))
    high = top_k(kept, [F.col(measure).desc(), F.col(tie)], k).withColumn("side", F.lit("highest"))
    return low.unionByName(high)


def keyed_split_counts(df: DataFrame, bucket: Column, cut: int) -> DataFrame:
    """Sizes of the two sides of a keyed split."""
    side = F.when(bucket < cut, F.lit("train")).otherwise(F.lit("test"))
    return count_by(df, side.alias("side"))
