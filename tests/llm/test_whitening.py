"""Whitening against a dense eigen-decomposition."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyfield.llm import queries
from tallyfield.llm import whitening as wh
from tallyfield.sources.tables import load_table


def plain(rows, components=4):
    """(id, component, n, deviation, |whitened|, explained) by numpy over all rows of one length."""
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(256 * float(c))) for c in v] for _, v in good])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e, kind="stable")[:components]
    out = []
    for (i, _), row in zip(good, x, strict=True):
        deviation = sum(int(d) ** 2 for d in n * row - sums)
        for k, column in enumerate(order, 1):
            if e[column] > 1e-9 * e.max():
                value = (n * row - sums) / n @ axes[:, column] / np.sqrt(e[column])
                out.append((i, k, n, deviation, value, e[column] / e.sum()))
    return out


def same(df, rows):
    mine = sorted(df.collect(), key=lambda r: (repr(r[0]), r.component))
    theirs = sorted(plain(rows), key=lambda r: (repr(r[0]), r[1]))
    assert [tuple(r)[:4] for r in mine] == [r[:4] for r in theirs]
    signs = {}
    for a, b in zip(mine, theirs, strict=True):
        if abs(b[4]) > 1e-6:
            sign = signs.setdefault(b[1], np.sign(a.whitened * b[4]))
            assert a.whitened == pytest.approx(sign * b[4], rel=1e-6, abs=1e-8)
        assert a.explained == pytest.approx(b[5], rel=1e-9)
        assert a.identity_error < 1e-10


@settings(deadline=None, max_examples=60)
@given(st.integers(0, 10**6), st.integers(1, 24), st.integers(1, 24))
def test_factor_and_rotations(seed, size, rank):
    rng = np.random.default_rng(seed)
    half = rng.normal(size=(size, min(rank, size))) * 10.0 ** rng.integers(-2, 3, (size, 1))
    g = half @ half.T
    factor = wh.pivoted_cholesky(g)
    assert factor.shape[1] <= min(rank, size)
    assert np.allclose(factor @ factor.T, g, rtol=1e-9, atol=1e-11 * np.trace(g))
    turned = wh.jacobi(factor)
    lengths = (turned * turned).sum(axis=0)
    assert (np.diff(lengths) <= 1e-12 * lengths.max()).all()
    unit = turned / np.sqrt(lengths)
    assert np.abs(unit.T @ unit - np.eye(len(lengths))).max() < 1e-12
    true = np.sort(np.linalg.eigvalsh(g))[::-1][:len(lengths)]
    assert np.allclose(lengths, true, rtol=1e-6, atol=1e-11 * true.max())


def test_zero_scatter():
    assert wh.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
    assert wh.jacobi(np.zeros((3, 0))).shape == (3, 0)


def test_equals_dense(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(300, 7)) @ rng.normal(size=(7, 7))).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(vectors + vectors[:40] * 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    same(wh.whiten(table), rows)


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(20, 3)).tolist())]
    odd = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [inf, 1.0, 1.0]), (94, [nan, 1.0, 1.0]), (None, rows[0][1]),
           (0, rows[0][1]), (95, [0.0, -0.0, 0.0])]
    table = spark.createDataFrame([(*r, "a", 1) for r in rows + odd], "vec_id long, embedding array<double>, x string, id int")
    same(wh.whiten(table), rows + odd)
    assert wh.whiten(table.limit(0)).collect() == []
    assert wh.whiten(table.filter("vec_id >= 90")).collect() == []  # one distinct vector has no variance
    two = wh.whiten(table.filter("vec_id in (1, 2)")).collect()
    assert [(r.component, round(abs(r.whitened), 9), r.explained) for r in two] == [(1, 1.0, pytest.approx(1.0))] * 2


def test_lengths_are_apart(spark):
    rng = np.random.default_rng(4)
    short = [(i, v) for i, v in enumerate(rng.normal(size=(9, 2)).tolist())]
    long = [(100 + i, v) for i, v in enumerate(rng.normal(size=(30, 6)).tolist())]
    df = wh.whiten(spark.createDataFrame(short + long, "vec_id long, embedding array<double>"))
    same(df.filter("vec_id < 100"), short)
    same(df.filter("vec_id >= 100"), long)


def test_large_numbers_stay_exact(spark):
    rows = [(1, [1e15, 3.0]), (2, [-1e15, 5.0]), (3, [2.5e14, 0.0]), (4, [1e30, 1.0])]
    found = {(r.vec_id, r.deviation) for r in wh.whiten(
        spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")).collect()}
    x = [[int(np.floor(256 * c)) for c in v] for _, v in rows[:3]]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert found == {(i, sum((3 * c - s) ** 2 for c, s in zip(v, sums, strict=True))) for i, v in zip((1, 2, 3), x, strict=True)}
    assert wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).count() == 8  # 1e30 is held to 64 bits


def test_query_equals_dense(spark, small_sf):
    rows = [(r.vec_id, r.embedding) for r in load_table(spark, small_sf, "embeddings").collect()]
    df = queries.op12_whitening(spark, small_sf)
    assert dict(df.dtypes)["deviation"] == "bigint"
    same(df, rows)
