"""Bins, category maps, rounding, array forms and registered SQL functions."""

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import (
    Bins, bin_label, dense_form, majority, map_category, ordinal_rank, presets, ratio,
    register_functions, round_half_even, round_stable, sparse_form,
)
from tallyfield.sources import local_rows


def column(spark, values, kind="DOUBLE"):
    return local_rows(spark, [[v] for v in values], f"x {kind}")


def labels(spark, values, bins):
    return [r[0] for r in column(spark, values).select(bin_label("x", bins)).collect()]


def test_right_closed_bins_at_every_edge(spark):
    values = [-1.0, 0.0, 1.0, 1.0001, 2.0, 3.0, 4.0, 5.0, 5.01, 6.0, 99.0, None]
    assert labels(spark, values, presets.CARAT_BINS) == [
        "[0,1)", "[0,1)", "[0,1)", "[1,2)", "[1,2)", "[2,3)", "[3,4)", "[4,5)", "[5,6]", "[5,6]",
        "[5,6]", None]


def test_left_closed_bins_at_every_edge(spark):
    values = [-0.01, 0.0, 0.99, 1.0, 2.0, 3.0, 3.99, 4.0, 4.01, None]
    assert labels(spark, values, presets.GPA_BINS) == [
        None, "[0,1)", "[0,1)", "[1,2)", "[2,3)", "[3,4]", "[3,4]", "[3,4]", None, None]


def test_closed_range_has_no_label_outside(spark):
    bins = Bins(edges=(0, 10, 20))
    assert labels(spark, [0.0, 0.1, 10.0, 10.1, 20.0, 20.1], bins) == [
        None, "(0,10]", "(0,10]", "(10,20]", "(10,20]", None]


@pytest.mark.parametrize("edges", [(1.0,), (1.0, 1.0), (2.0, 1.0)])
def test_bad_edges_are_refused(edges):
    with pytest.raises(ValueError):
        Bins(edges=edges)


def test_category_maps(spark):
    df = column(spark, ["A", "B", "C", "D", "F", "W", None], "STRING")
    got = [r[0] for r in df.select(map_category("x", presets.GRADE_POINTS)).collect()]
    assert got == [4, 3, 2, 1, 0, None, None]
    cuts = column(spark, ["Ideal", "Fair", "Very Good", "Good", "Premium", "Odd"], "STRING")
    rank = ordinal_rank("x", presets.CUT_ORDER, default=5)
    assert [r[0] for r in cuts.select(rank).collect()] == [5, 1, 3, 2, 4, 5]


def test_registered_functions_equal_column_builders_and_inline(spark):
    assert register_functions(spark) == ["rank_cut", "carat_bin", "convert_grade", "get_gpa_range"]
    df = column(spark, [-1.0, 0.0, 1.0, 1.5, 2.0, 3.0, 4.0, 4.5, 6.0, None])
    rows = df.select(
        F.expr("CARAT_BIN(x)"), bin_label("x", presets.CARAT_BINS),
        F.call_function("get_gpa_range", F.col("x")), bin_label("x", presets.GPA_BINS)).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in rows)
    words = column(spark, ["A", "F", "Z", "Fair", "Ideal"], "STRING")
    rows = words.select(F.expr("convert_grade(x)"), F.expr("rank_cut(x)")).collect()
    assert [tuple(r) for r in rows] == [(4, 5), (0, 5), (None, 5), (None, 1), (None, 5)]
    plan = df.select(F.expr("carat_bin(x)"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_rounding(spark):
    rows = column(spark, [0.125, 2.5, -0.125, None]).select(
        round_stable(F.col("x"), 2), round_half_even(F.col("x"), 2)).collect()
    assert [r[0] for r in rows] == [0.13, 2.5, -0.13, None]
    assert [r[1] for r in rows] == [round(v, 2) if v is not None else None for v in (0.125, 2.5, -0.125, None)]
    assert column(spark, [1.0]).select(ratio(F.col("x"), F.lit(0))).first()[0] is None


def test_order_of_summation_does_not_move_a_tie(spark):
    parts = [0.1] * 3 + [0.025, 0.3, 0.4]
    up = column(spark, parts).coalesce(1).agg(round_stable(F.sum("x"), 2)).first()[0]
    down = column(spark, parts[::-1]).coalesce(1).agg(round_stable(F.sum("x"), 2)).first()[0]
    assert up == down == 1.03


SPARSE = [
    ([0, 0, 0, 1, 1, 0, 0, 0], (8, [3, 4], [1, 1])),
    ([0, 0, 4, 0, 7, 0, 0, 0, 2, 0], (10, [2, 4, 8], [4, 7, 2])),
    ([4, 1, 8], (3, [0, 1, 2], [4, 1, 8])),
    ([0, 0, 0, 0, 0, 0], (6, [], [])),
    ([], (0, [], [])),
]


@pytest.mark.parametrize("dense,sparse", SPARSE)
def test_sparse_and_dense_forms(spark, dense, sparse):
    df = local_rows(spark, [[[float(v) for v in dense]]], "x ARRAY<DOUBLE>")
    row = df.select(sparse_form(F.col("x")).alias("s")).select(
        "s.*", dense_form(F.col("s.size"), F.col("s.indices"), F.col("s.values")).alias("d")).first()
    assert (row["size"], row["indices"], row["values"]) == sparse
    assert row["d"] == dense


def test_majority_in_row(spark):
    df = local_rows(spark, [[0.0, 0.0, 1.0], [2.0, 1.0, 0.0], [1.0, 2.0, 2.0]], "a DOUBLE, b DOUBLE, c DOUBLE")
    assert [r[0] for r in df.select(majority(["a", "b", "c"])).collect()] == [0.0, 0.0, 2.0]
