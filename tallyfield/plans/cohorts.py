"""Customer cohorts: who enrolled, who left and how, and how their first year went.

Members are the customers, activity is their orders since a start date, and three exit sets are
the customers with a late order of one status each.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfield.functions import presets, bin_label, ratio
from tallyfield.operators.aggregates import class_share, count_by, weighted_mean_by
from tallyfield.operators.joins import (
    cohort_flags_from_events, cohort_sizes_from_events, first_period_rows, match, outer_rate, rate_per_bin,
)
from tallyfield.plans.relational import SCORE_SQL, order_scores
from tallyfield.sources import load_table

ENROLLED_FROM = "2000-01-01"
EXITS = {
    "alumni": ("F", "2001-06-01"),
    "unretained": ("P", "2001-07-15"),
    "expelled": ("O", "2001-07-22"),
}


def members(spark, sf):
    return load_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))


def known_orders(spark, sf):
    return load_table(spark, sf, "orders").filter(F.col("o_custkey").isNotNull())


def exit_conditions():
    return {
        name: (F.col("o_orderstatus") == status) & (F.col("o_orderdate") >= since)
        for name, (status, since) in EXITS.items()
    }


def flags(spark, sf):
    conditions = {"enrolled": F.col("o_orderdate") >= ENROLLED_FROM, **exit_conditions()}
    return cohort_flags_from_events(
        members(spark, sf), "o_custkey", known_orders(spark, sf), conditions)


def current(spark, sf):
    return flags(spark, sf).filter("is_current").select("o_custkey", "segment")


def status_cohorts(spark, sf):
    conditions = {"enrolled": F.col("o_orderdate") >= ENROLLED_FROM, **exit_conditions()}
    return cohort_sizes_from_events(
        members(spark, sf), "o_custkey", known_orders(spark, sf), conditions)


def current_share(spark, sf):
    return class_share(current(spark, sf), "segment").orderBy(F.col("share").desc(), "segment")


def outer_join_rate(spark, sf):
    former = flags(spark, sf).filter("is_former")
    n_former = count_by(former, "segment", name="n_former")
    n_alumni = count_by(former.filter("alumni"), "segment", name="n_alumni")
    return outer_rate(n_alumni, n_former, "segment", "n_alumni", "n_former").orderBy("segment")


def current_means(spark, sf):
    means = weighted_mean_by(order_scores(spark, sf), ["o_custkey"], "score", "weight")
    return match(means, current(spark, sf), "o_custkey")


def perfect_means(spark, sf):
    """Current members with the best mean that any of them has."""
    means = current_means(spark, sf)
    return match(means, means.agg(F.max("mean").alias("mean")), "mean").select("o_custkey", "mean", "segment")


def first_period_means(spark, sf):
    """Weighted mean score over each customer's first order year.

    Scores are added up per customer and year before the two-key join.
    """
    scores = order_scores(spark, sf)
    yearly = scores.groupBy("o_custkey", "order_year").agg(
        F.sum(F.col("score") * F.col("weight")).alias("points"), F.sum("weight").alias("weight"))
    starts = load_table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min(F.year("o_orderdate")).alias("first_year"))
    first = first_period_rows(yearly, starts, "o_custkey", "order_year", "first_year")
    return first.select("o_custkey", ratio(F.col("points"), F.col("weight"), 2).alias("first_mean"))


def rate_by_bin(spark, sf):
    binned = first_period_means(spark, sf).select(
        "o_custkey", bin_label("first_mean", presets.GPA_BINS).alias("bin"))
    flagged = match(binned, flags(spark, sf), "o_custkey")
    return rate_per_bin(flagged, "bin", "alumni", "is_former", "n_alumni", "n_former").orderBy("bin")


QUERIES = {
    "status_cohorts": status_cohorts,
    "current_class_share": current_share,
    "outer_join_rate": outer_join_rate,
    "current_weighted_means": current_means,
    "perfect_means": perfect_means,
    "first_period_ratio": first_period_means,
    "rate_by_bin": rate_by_bin,
}

_SETS = f"""
WITH enrolled AS (
  SELECT * FROM customer WHERE c_custkey IN
    (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{ENROLLED_FROM}')),
{"".join(f'''
{name} AS (SELECT DISTINCT o_custkey FROM orders
  WHERE o_orderstatus = '{status}' AND o_orderdate >= TIMESTAMP '{since}'),'''
  for name, (status, since) in EXITS.items())}
current_members AS (
  SELECT * FROM enrolled
  WHERE c_custkey NOT IN (SELECT o_custkey FROM alumni)
    AND c_custkey NOT IN (SELECT o_custkey FROM unretained)
    AND c_custkey NOT IN (SELECT o_custkey FROM expelled)),
former AS (
  SELECT * FROM enrolled WHERE c_custkey NOT IN (SELECT c_custkey FROM current_members)),
means AS (
  SELECT o_custkey, round(sum({SCORE_SQL} * l_quantity) / sum(l_quantity) + 1e-9, 2) AS mean
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
starts AS (SELECT o_custkey AS k, min(year(o_orderdate)) AS first_year FROM orders GROUP BY 1),
first_means AS (
  SELECT o_custkey, round(sum({SCORE_SQL} * l_quantity) / sum(l_quantity) + 1e-9, 2) AS first_mean
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
       JOIN starts ON k = o_custkey AND first_year = year(o_orderdate)
  GROUP BY 1)
"""

ORACLE = {
    "status_cohorts": f"""{_SETS}
        SELECT 'accepted' AS cohort, count(*) AS n FROM customer
        UNION ALL SELECT 'enrolled', count(*) FROM enrolled
        UNION ALL SELECT 'current', count(*) FROM current_members
        UNION ALL SELECT 'former', count(*) FROM former
        UNION ALL SELECT 'alumni', count(*) FROM alumni
        UNION ALL SELECT 'unretained', count(*) FROM unretained
        UNION ALL SELECT 'expelled', count(*) FROM expelled""",
    "current_class_share": f"""{_SETS}
        SELECT c_mktsegment AS segment, count(*) AS n,
               round(count(*)::DOUBLE / (SELECT count(*) FROM current_members) + 1e-9, 4) AS share
        FROM current_members GROUP BY 1""",
    "outer_join_rate": f"""{_SETS},
        f AS (SELECT c_mktsegment AS segment, count(*) AS n_former FROM former GROUP BY 1),
        a AS (SELECT c_mktsegment AS segment, count(*) AS n_alumni FROM former
              WHERE c_custkey IN (SELECT o_custkey FROM alumni) GROUP BY 1)
        SELECT segment, n_alumni, n_former,
               round(n_alumni::DOUBLE / n_former + 1e-9, 4) AS rate
        FROM a FULL JOIN f USING (segment)""",
    "current_weighted_means": f"""{_SETS}
        SELECT o_custkey, mean, c_mktsegment AS segment
        FROM means JOIN current_members ON c_custkey = o_custkey""",
    "perfect_means": f"""{_SETS}
        SELECT o_custkey, mean, c_mktsegment AS segment
        FROM means JOIN current_members ON c_custkey = o_custkey
        WHERE mean = (SELECT max(mean) FROM means JOIN current_members ON c_custkey = o_custkey)""",
    "first_period_ratio": f"{_SETS} SELECT o_custkey, first_mean FROM first_means",
    "rate_by_bin": f"""{_SETS},
        b AS (SELECT o_custkey, CASE WHEN first_mean >= 0 AND first_mean < 1 THEN '[0,1)'
                                     WHEN first_mean >= 1 AND first_mean < 2 THEN '[1,2)'
                                     WHEN first_mean >= 2 AND first_mean < 3 THEN '[2,3)'
                                     WHEN first_mean >= 3 AND first_mean <= 4 THEN '[3,4]' END AS bin
              FROM first_means),
        a AS (SELECT bin, count(*) AS n_alumni FROM b
              WHERE o_custkey IN (SELECT o_custkey FROM alumni) GROUP BY 1),
        f AS (SELECT bin, count(*) AS n_former FROM b
              WHERE o_custkey IN (SELECT c_custkey FROM former) GROUP BY 1)
        SELECT bin, n_alumni, n_former, round(n_alumni::DOUBLE / n_former + 1e-9, 4) AS rate
        FROM a JOIN f USING (bin)""",
}
