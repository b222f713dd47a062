"""Numeric sets, parsed number pairs and tab-separated lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfield.operators.aggregates import fit_quality, grouped_means, histogram, numeric_summary
from tallyfield.operators.lines import parse_numbers, parse_records
from tallyfield.sources import load_table, local_rows

STATS = ("total", "mean", "stdev", "minimum", "maximum")


def _rounded_summary(spark, sf, column):
    stats = numeric_summary(load_table(spark, sf, "lineitem"), column)
    return stats.select(*[F.round(name, 4).alias(name) for name in STATS])


def price_summary(spark, sf):
    return _rounded_summary(spark, sf, F.col("l_extendedprice"))


def scaled_stats(spark, sf):
    return _rounded_summary(spark, sf, F.col("l_extendedprice") * 10)


def log_transform_stats(spark, sf):
    """NULL stands for the logarithm of zero."""
    return _rounded_summary(spark, sf, F.log(F.col("l_extendedprice") * 10))


def pair_parse_r2(spark, sf):
    """Actual price and a guess from the quantity, as text lines of two numbers."""
    lines = load_table(spark, sf, "lineitem").select(
        F.concat_ws(" ", F.col("l_extendedprice").cast("string"),
                    (F.col("l_quantity") * 1500).cast("string")).alias("line"))
    pairs = parse_numbers(lines, ["actual", "predicted"])
    # Squared prices add up to 1e13 and more, where a double's last digit is near the cents.
    return fit_quality(pairs, "actual", "predicted").select(
        "n", F.round("mean_actual", 4).alias("mean_actual"), F.round("sse", 0).alias("sse"),
        F.round("sst", 0).alias("sst"), F.round("r2", 12).alias("r2"))


def line_parse_grouped_mean(spark, sf):
    """Parts as tab-separated lines below a header line."""
    fields = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    header = "\t".join(fields)
    part = load_table(spark, sf, "part")
    body = part.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in fields]).alias("line"))
    lines = local_rows(spark, [[header]], "line STRING").unionAll(body)
    rows = parse_records(
        lines,
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE",
        header=header,
    )
    means = {"mean_size": "p_size", "mean_price": "p_retailprice"}
    return grouped_means(rows, ["p_type"], means)


def balance_histogram(spark, sf):
    return histogram(load_table(spark, sf, "customer"), "c_acctbal", -1000.0, 500.0, 22)


QUERIES = {
    "numeric_summary": price_summary,
    "scaled_stats": scaled_stats,
    "log_transform_stats": log_transform_stats,
    "pair_parse_r2": pair_parse_r2,
    "line_parse_grouped_mean": line_parse_grouped_mean,
    "histogram": balance_histogram,
}


def _summary_sql(x: str) -> str:
    # Compensated sums; the spread around a mean that is known first.
    return f"""
        WITH v AS (SELECT {x} AS x FROM lineitem), m AS (SELECT fsum(x) / count(x) AS mean FROM v)
        SELECT round(fsum(x), 4) AS total, round(any_value(mean), 4) AS mean,
               round(sqrt(fsum((x - mean) * (x - mean)) / count(x)), 4) AS stdev,
               round(min(x), 4) AS minimum, round(max(x), 4) AS maximum
        FROM v, m"""


ORACLE = {
    "numeric_summary": _summary_sql("l_extendedprice"),
    "scaled_stats": _summary_sql("l_extendedprice * 10"),
    "log_transform_stats": _summary_sql("ln(l_extendedprice * 10)"),
    "pair_parse_r2": """
        WITH m AS (SELECT fsum(l_extendedprice) / count(*) AS mean_actual FROM lineitem),
        e AS (SELECT l_extendedprice - 1500 * l_quantity AS e, l_extendedprice - mean_actual AS d FROM lineitem, m),
        s AS (SELECT count(*) AS n, fsum(e * e) AS sse, fsum(d * d) AS sst FROM e)
        SELECT n, round(mean_actual, 4) AS mean_actual, round(sse, 0) AS sse,
               round(sst, 0) AS sst, round(1 - sse / sst, 12) AS r2
        FROM s, m""",
    "line_parse_grouped_mean": """
        SELECT p_type, count(*) AS n, round(avg(p_size) + 1e-9, 2) AS mean_size,
               round(avg(p_retailprice) + 1e-9, 2) AS mean_price
        FROM part GROUP BY 1""",
    "histogram": """
        WITH b AS (SELECT i AS bucket FROM generate_series(0, 21) AS t(i)),
        c AS (SELECT least(CAST(floor((c_acctbal + 1000) / 500) AS BIGINT), 21) AS bucket,
                     count(*) AS n
              FROM customer WHERE c_acctbal BETWEEN -1000 AND 10000 GROUP BY 1)
        SELECT bucket, CAST(-1000 + bucket * 500 AS DOUBLE) AS low,
               CAST(-500 + bucket * 500 AS DOUBLE) AS high, coalesce(n, 0) AS n
        FROM b LEFT JOIN c USING (bucket)""",
}
