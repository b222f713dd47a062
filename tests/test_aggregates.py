"""Aggregates on small tables with hand-made results."""

import statistics

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import Bins
from tallyfield.operators import aggregates as agg
from tallyfield.sources import local_rows


def test_numeric_summary_uses_the_population_deviation(spark):
    values = [1.0, 2.0, 4.0, 8.5]
    df = local_rows(spark, [[v] for v in values], "x DOUBLE")
    row = agg.numeric_summary(df, "x").first()
    assert (row.total, row.minimum, row.maximum) == (15.5, 1.0, 8.5)
    assert row.stdev == pytest.approx(statistics.pstdev(values))
    assert row["mean"] == pytest.approx(statistics.mean(values))


def test_fit_quality(spark):
    pairs = [(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)]
    mean = 7 / 3
    sse = sum((a - p) ** 2 for a, p in pairs)
    sst = sum((a - mean) ** 2 for a, _ in pairs)
    row = agg.fit_quality(local_rows(spark, pairs, "a DOUBLE, p DOUBLE"), "a", "p").first()
    assert (row.sse, row.sst, row.r2) == pytest.approx((sse, sst, 1 - sse / sst))


def test_fit_quality_of_a_constant_has_no_r2(spark):
    row = agg.fit_quality(local_rows(spark, [(1.0, 2.0)], "a DOUBLE, p DOUBLE"), "a", "p").first()
    assert row.r2 is None


def test_histogram_closes_the_last_bucket_and_lists_empty_ones(spark):
    values = [0.0, 0.24, 0.25, 3.75, 4.0, 4.01, -0.1, None]
    df = local_rows(spark, [[v] for v in values], "x DOUBLE")
    rows = agg.histogram(df, "x", 0.0, 0.25, 16).orderBy("bucket").collect()
    assert len(rows) == 16
    assert {r.bucket: r.n for r in rows if r.n} == {0: 2, 1: 1, 15: 2}
    assert (rows[15].low, rows[15].high) == (3.75, 4.0)


def test_weighted_mean_and_rows_without_a_value(spark):
    rows = [("a", 4, 3), ("a", None, 1), ("b", None, 2), ("c", 2, 0)]
    df = local_rows(spark, rows, "k STRING, v INT, w INT")
    kept = {r.k: r["mean"] for r in agg.weighted_mean_by(df, ["k"], "v", "w").collect()}
    assert kept == {"a": 3.0, "b": None, "c": None}
    graded = {r.k: r["mean"] for r in
              agg.weighted_mean_by(df, ["k"], "v", "w", ungraded="exclude").collect()}
    assert graded == {"a": 4.0, "b": None, "c": None}
    with pytest.raises(ValueError):
        agg.weighted_mean_by(df, ["k"], "v", "w", ungraded="drop")


def test_shares_and_conditional_shares(spark):
    df = local_rows(spark, [("a", "x"), ("a", "y"), ("b", "x"), ("a", None)], "k STRING, g STRING")
    assert {r.k: (r.n, r.share) for r in agg.class_share(df, "k").collect()} == {
        "a": (3, 0.75), "b": (1, 0.25)}
    shares = agg.conditional_shares(df, ["k"], "g", {"x_share": "x", "y_share": "y"}).collect()
    assert {r.k: (r.n, r.x_share, r.y_share) for r in shares} == {"a": (2, 0.5, 0.5), "b": (1, 1.0, 0.0)}


def test_frequency_of_distinct_counts(spark):
    rows = [(1, "t1"), (1, "t1"), (1, "t2"), (2, "t1"), (3, "t9")]
    df = local_rows(spark, rows, "k INT, t STRING")
    assert {tuple(r) for r in agg.distinct_count_frequency(df, "k", "t").collect()} == {(1, 2), (2, 1)}


def test_extremes_need_support_and_break_ties_by_key(spark):
    rows = [(1, 100, 0.5), (2, 100, 0.5), (3, 99, 0.0), (4, 200, 0.9)]
    df = local_rows(spark, rows, "k INT, n INT, m DOUBLE")
    got = agg.supported_extremes(df, "n", 100, "m", "k", 2).collect()
    assert {(r.side, r.k) for r in got} == {("lowest", 1), ("lowest", 2), ("highest", 4), ("highest", 1)}


def test_bins_and_substrings(spark):
    df = local_rows(spark, [[0.5], [1.0], [1.5], [9.0]], "x DOUBLE")
    bins = Bins(edges=(0.0, 1.0, 2.0))
    assert {r.bin: r.n for r in agg.counts_per_bin(df, "x", bins).collect()} == {"(0,1]": 2, "(1,2]": 1}
    lines = local_rows(spark, [["GET a"], ["POST GET"], ["none"]], "line STRING")
    row = agg.substring_counts(lines, "line", {"g": "GET", "p": "POST"}).first()
    assert tuple(row) == (2, 1)


def test_partitioning_does_not_change_results(spark, small_sf):
    items = spark.read.parquet(f"{small_sf}/lineitem.parquet")

    def result(df):
        means = agg.grouped_means(df, ["l_suppkey"], {"m": "l_extendedprice"})
        shares = agg.conditional_shares(df, ["l_suppkey"], "l_returnflag", {"a": "A"})
        weighted = agg.weighted_mean_by(df, ["l_suppkey"], "l_quantity", "l_tax")
        return [sorted(map(tuple, x.collect())) for x in (means, shares, weighted)]

    assert result(items) == result(items.repartition(13)) == result(items.orderBy(F.rand(5)))


def test_sums_do_not_depend_on_the_partitioning(spark, sf):
    items = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_extendedprice")
    found = {
        tuple(agg.numeric_summary(items.repartition(n), "l_extendedprice").first()) for n in (1, 3, 8, 16, 40)}
    assert len(found) == 1


def test_cohort_sizes_of_both_forms_agree(spark):
    from pyspark.sql import functions as F

    from tallyfield.operators import joins
    members = local_rows(spark, [[k] for k in range(1, 9)], "k INT")
    events = local_rows(spark, [[k, k * s, s] for k in range(3, 12) for s in (1, 2, 3)], "k INT, t INT, s INT")
    conditions = {"enrolled": F.col("t") > 6, "a": (F.col("s") == 1) & (F.col("t") > 8), "b": F.col("t") > 21}
    sets = {name: events.filter(c).select("k").distinct() for name, c in conditions.items()}
    activity = sets.pop("enrolled")
    one = joins.cohort_sizes(members, "k", activity, sets)
    two = joins.cohort_sizes_from_events(members, "k", events, conditions)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
