"""Readers, generators, table reports and scratch folders."""

import pytest
from pyspark.sql import functions as F

from tallyfield import sources
from tallyfield.operators.sampling import bernoulli_sample, keyed_sample, keyed_split, random_split
from tallyfield.sources.schemas import SCHEMAS, SEPARATORS


def test_delimited_round_trip(spark, tmp_path):
    rows = [("2021A", "BIO 101", 1, 7, "A"), ("2021B", "CHE, 2", 2, None, "W")]
    df = sources.local_rows(spark, rows, SCHEMAS["grades"])
    path = sources.write_delimited(df, str(tmp_path / "grades"))
    back = sources.read_delimited(spark, path, "grades")
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert sources.read_delimited_inferred(spark, path).dtypes[2] == ("sid", "int")


def test_declared_schema_goes_by_position_and_bad_fields_are_null(spark, tmp_path):
    (tmp_path / "d.txt").write_text("one\ttwo\n1\tx\nbad\ty\n")
    df = sources.read_delimited(spark, str(tmp_path / "d.txt"), "a INT, b STRING", sep="\t")
    assert sorted(map(tuple, df.collect()), key=str) == [(1, "x"), (None, "y")]


def test_every_registered_schema_has_a_separator_and_parses(spark):
    assert SCHEMAS.keys() == SEPARATORS.keys()
    for ddl in SCHEMAS.values():
        assert sources.local_rows(spark, [], ddl).count() == 0


def test_lines(spark, tmp_path):
    df = sources.local_rows(spark, [["a b"], ["c"]], "line STRING")
    path = sources.write_lines(df, str(tmp_path / "lines"))
    assert sorted(r.line for r in sources.read_lines(spark, path).collect()) == ["a b", "c"]


def test_generators(spark):
    df = sources.uniform_values(spark, 1000, seed=1)
    assert df.collect() == sources.uniform_values(spark, 1000, seed=1).collect()
    low, high, n = df.agg(F.min("x"), F.max("x"), F.count("x")).first()
    assert 0 <= low < high < 1 and n == 1000


def test_table_reports(spark):
    df = spark.range(0, 100, 1, 4)
    assert sum(r.n for r in sources.partition_sizes(df).collect()) == 100
    assert {r.table_name: r.n for r in sources.row_counts({"a": df, "b": df.limit(3)}).collect()} == {"a": 100, "b": 3}
    assert [r.id for r in sources.head_rows(df, ["id"], 3).collect()] == [0, 1, 2]


def test_spread_leaves_large_tables_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert sources.spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == cores
    wide = spark.range(0, 1000, 1, cores + 3)
    assert sources.spread(wide) is wide


def test_keyed_split_is_repeatable_and_whole(spark):
    df = spark.range(10_000)
    first, rest = keyed_split(df, ["id"], 0.8, seed=1)
    again, _ = keyed_split(df.repartition(7), ["id"], 0.8, seed=1)
    assert {r.id for r in first.collect()} == {r.id for r in again.collect()}
    assert first.count() + rest.count() == 10_000 and 7800 < first.count() < 8200


def test_random_split_and_sample(spark):
    df = spark.range(1000)
    parts = random_split(df, [0.8, 0.2], seed=1)
    assert sum(p.count() for p in parts) == 1000
    assert 150 < bernoulli_sample(df, 0.25, seed=1).count() < 350


class Remote:
    """A session of a cluster without a shared folder."""

    class sparkContext:
        master = "spark://host:7077"

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_scratch_folders_are_new_and_shared(spark):
    assert sources.scratch_dir(spark, "x") != sources.scratch_dir(spark, "x")
    with pytest.raises(RuntimeError):
        sources.scratch_dir(Remote, "x")


def test_keyed_values_and_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(4000).selectExpr("id AS k", "if(id % 10 = 0, NULL, id % 7) AS part")
    one, two = (sources.with_uniform(df.repartition(n), 3, keys=["k", "part"]) for n in (1, 13))
    values = {r.k: r.x for r in one.collect()}
    assert values == {r.k: r.x for r in two.collect()}
    assert 0 <= min(values.values()) and max(values.values()) < 1 and len(set(values.values())) > 3990
    assert abs(sum(values.values()) / 4000 - 0.5) < 0.03
    kept = {r.k for r in keyed_sample(df.repartition(5), ["k", "part"], 0.25, seed=3).collect()}
    assert kept == {k for k, x in values.items() if x < 0.25} and 850 < len(kept) < 1150
    assert keyed_sample(df, ["k"], 0.0).count() == 0 and keyed_sample(df, ["k"], 1.0).count() == 4000
    assert keyed_sample(df.limit(0), ["k"], 0.5).count() == 0
