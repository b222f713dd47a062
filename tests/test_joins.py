"""Joins, cohorts and rates, with duplicate and hot keys."""

import pytest
from pyspark.sql import functions as F

from tallyfield.operators import joins
from tallyfield.operators.aggregates import count_by
from tallyfield.sources import local_rows


def ids(spark, values, name="k"):
    return local_rows(spark, [[v] for v in values], f"{name} INT")


def test_joins_need_a_key(spark):
    for join in (joins.lookup, joins.match, joins.full_match, joins.keep_in):
        with pytest.raises(ValueError):
            join(ids(spark, [1]), ids(spark, [1]), [])


def test_semi_join_does_not_multiply_and_anti_joins_chain(spark):
    base = ids(spark, [1, 2, 3, 4, 5])
    assert sorted(r.k for r in joins.keep_in(base, ids(spark, [2, 2, 3]), "k").collect()) == [2, 3]
    left = joins.drop_in(base, "k", ids(spark, [1]), ids(spark, [2, 2]), ids(spark, [9]))
    assert sorted(r.k for r in left.collect()) == [3, 4, 5]


def test_full_match_coalesces_the_key_and_rates_survive_zero(spark):
    part = local_rows(spark, [("a", 1), ("b", 2)], "g STRING, p INT")
    whole = local_rows(spark, [("a", 4), ("c", 0)], "g STRING, w INT")
    rows = {r.g: (r.p, r.w, r.rate) for r in joins.outer_rate(part, whole, "g", "p", "w").collect()}
    assert rows == {"a": (1, 4, 0.25), "b": (2, None, None), "c": (None, 0, None)}


MEMBERS = [1, 2, 3, 4, 5, 6]
ACTIVE = [1, 1, 1, 2, 3, 4, 9]
LEFT = {"alumni": [2], "unretained": [3, 3], "expelled": [6]}


def test_cohorts(spark):
    exits = {name: ids(spark, keys) for name, keys in LEFT.items()}
    sizes = joins.cohort_sizes(ids(spark, MEMBERS), "k", ids(spark, ACTIVE), exits)
    got = {r.cohort: r.n for r in sizes.collect()}
    assert got == {"accepted": 6, "enrolled": 4, "current": 2, "former": 2, "alumni": 1,
                   "unretained": 2, "expelled": 1}
    assert got["enrolled"] == got["current"] + got["former"]


def test_cohorts_from_one_event_table_are_the_same(spark):
    kinds = {"enrolled": ACTIVE, **LEFT}
    events = local_rows(spark, [(k, kind) for kind, keys in kinds.items() for k in keys], "k INT, kind STRING")
    conditions = {kind: F.col("kind") == kind for kind in kinds}
    one = joins.cohort_flags_from_events(ids(spark, MEMBERS), "k", events, conditions)
    many = joins.cohort_flags(
        ids(spark, MEMBERS), "k", ids(spark, ACTIVE), {n: ids(spark, v) for n, v in LEFT.items()})
    assert sorted(map(tuple, one.select(many.columns).collect())) == sorted(map(tuple, many.collect()))


def test_top_with_lookup_equals_cutting_last(spark):
    measures = local_rows(spark, [(i, i % 4) for i in range(40)], "k INT, m INT")
    dimension = local_rows(spark, [(i, f"n{i}-{j}") for i in range(0, 40, 2) for j in range(2)], "k INT, name STRING")
    order = [F.col("m").desc(), F.col("k"), F.col("name")]
    fast = joins.top_with_lookup(measures, dimension, "k", [F.col("m").desc(), F.col("k")], 7)
    slow = joins.lookup(measures, dimension, "k").orderBy(*order).limit(7)
    assert [(r.k, r.m) for r in fast.collect()] == [(r.k, r.m) for r in slow.collect()]


def test_first_period_and_rate_per_bin(spark):
    sums = local_rows(spark, [(1, "t1", 5), (1, "t2", 9), (2, "t2", 7)], "k INT, t STRING, s INT")
    members = local_rows(spark, [(1, "t1"), (2, "t1")], "k INT, start STRING")
    rows = joins.first_period_rows(sums, members, "k", "t", "start").collect()
    assert [(r.k, r.s) for r in rows] == [(1, 5)]
    flagged = local_rows(
        spark, [("x", True, True), ("x", False, True), ("y", False, True), (None, True, True)],
        "bin STRING, a BOOLEAN, f BOOLEAN")
    rates = joins.rate_per_bin(flagged, "bin", "a", "f", "n_a", "n_f").collect()
    assert [tuple(r) for r in rates] == [("x", 1, 2, 0.5)]


def test_a_hot_key_is_split_and_no_row_is_lost(spark):
    """A third of all fact rows share one key and neither side may be broadcast."""
    hot = spark.newSession()
    for key, value in {
        "autoBroadcastJoinThreshold": "-1",
        "adaptive.autoBroadcastJoinThreshold": "-1",
        "adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "adaptive.skewJoin.skewedPartitionFactor": "2",
        "adaptive.advisoryPartitionSizeInBytes": "20000",
        "adaptive.coalescePartitions.minPartitionSize": "10000",
    }.items():
        hot.conf.set(f"spark.sql.{key}", value)
    facts = hot.range(0, 300_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 1000).alias("k"),
        (F.col("id") % 10).alias("g"))
    dimension = hot.range(-1, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = joins.lookup(facts, dimension, "k").groupBy("g").agg(
        F.count("*").alias("n"), F.count("v").alias("n_v"))
    rows = joined.collect()
    expected = facts.filter("k < 500").count()
    assert sum(r.n for r in rows) == 300_000
    assert sum(r.n_v for r in rows) == expected
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    kept = count_by(joins.keep_in(facts, dimension, "k"), "g")
    assert sum(r.n for r in kept.collect()) == expected
    # The hot side as the key set: it is reduced before it is shuffled.
    found = joins.keep_in(dimension, facts, "k")
    assert found.count() == facts.filter("k < 500").select("k").distinct().count()
    missing = joins.drop_in(dimension, "k", facts)
    assert missing.count() == dimension.count() - found.count()
