"""Nearest vectors against all inner products."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyfield.llm import neighbours as nb
from tallyfield.llm import queries
from tallyfield.sources.tables import load_table


def plain(rows, k=20, every=20):
    """{query id: [(id, score)]} of all candidates, nearest first, k of them."""
    good = list(dict.fromkeys((i, tuple(v)) for i, v in rows if i is not None and v
                              and all(c is not None and np.isfinite(c) for c in v) and any(v)))
    out = {}
    for q, v in good:
        if q % every == 0:
            scores = [(i, float(np.sum(np.array(v, float) * np.array(w, float)))) for i, w in good if i != q and len(w) == len(v)]
            out[q] = sorted(scores, key=lambda x: (-x[1], x[0]))[:k]
    return {q: best for q, best in out.items() if best}


def shown(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(found, true):
    assert set(found) == set(true)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in true[q]}) for q in true)
    return hits / sum(map(len, true.values()))


def close(found, true):
    assert list(found) == list(true)
    for q in true:
        assert [i for i, _ in found[q]] == [i for i, _ in true[q]]
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in true[q]], rel=1e-12, abs=1e-15)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)


@settings(deadline=None, max_examples=40)
@given(st.integers(0, 10**6), st.integers(1, 64), st.integers(0, 64))
def test_probing_retrieves_the_radius(seed, bits, radius):
    rng = np.random.default_rng(seed)
    mask = np.uint64((1 << bits) - 1)
    codes = rng.integers(0, 2**63, 200).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, 200).astype(np.uint64)
    codes = codes & mask
    asked = np.concatenate([codes[:5], codes[5:10] ^ np.uint64(1), rng.integers(0, 2**63, 4).astype(np.uint64) & mask])
    found = nb.Index(codes, bits).within(asked, min(radius, bits))
    assert (found == (np.bitwise_count(asked[:, None] ^ codes) <= min(radius, bits))).all()


@settings(deadline=None, max_examples=40)
@given(st.integers(0, 10**6), st.integers(1, 9))
def test_extra_entry_turns_distance_into_product(seed, dims):
    rng = np.random.default_rng(seed)
    rows, asked = rng.normal(size=(12, dims)) * 10.0 ** rng.integers(-3, 3, (12, 1)), rng.normal(size=(1, dims))
    points = nb.placed(rows, np.linalg.norm(rows, axis=1).max(), False)
    apart = ((points - nb.placed(asked, 1.0, True)) ** 2).sum(axis=1)
    products = rows @ asked[0]
    nearer = np.abs(np.subtract.outer(apart, apart)) > 1e-9
    assert ((np.subtract.outer(apart, apart) < 0) == (np.subtract.outer(products, products) > 0))[nearer].all()


@pytest.mark.parametrize("lengths", [False, True])
def test_recall(spark, monkeypatch, lengths):
    monkeypatch.setattr(nb, "BLOCK_LIMITS", (64, 128))
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 24))
    vectors = centres[rng.integers(0, 30, 900)] + rng.normal(size=(900, 24)) * rng.uniform(0.01, 1.5, (900, 1))
    if lengths:
        vectors *= rng.uniform(0.1, 5, (900, 1))
    rows = [(i, v) for i, v in enumerate(vectors.tolist())]
    found, true = shown(nb.nearest(frame(spark, rows))), plain(rows)
    assert recall(found, true) >= 0.95
    scores = {(q, i): s for q, best in plain(rows, k=900).items() for i, s in best}
    for q, best in found.items():
        assert [s for _, s in best] == pytest.approx([scores[q, i] for i, _ in best], rel=1e-12)
        assert best == sorted(best, key=lambda x: (-x[1], x[0])) and len(best) == 20


def test_copies_and_ties(spark, monkeypatch):
    monkeypatch.setattr(nb, "BLOCK_LIMITS", (16, 16))
    rng = np.random.default_rng(2)
    one, other = rng.normal(size=8).tolist(), [0.0] * 7 + [1.0]
    ties = [[0.0] * j + [1.0] + [0.0] * (7 - j) for j in range(7)]
    rows = [(i, one) for i in range(300)] + [(300 + i, ties[i % 7]) for i in range(70)] + [(400, other), (401, [-c for c in one])]
    close(shown(nb.nearest(frame(spark, rows + rows[:50]))), plain(rows))


def test_few_found_are_searched_again(spark, monkeypatch):
    monkeypatch.setattr(nb, "MISSED", 1.0)  # the smallest radius that any neighbour has
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(120, 16)).tolist())]
    found = shown(nb.nearest(frame(spark, rows)))
    assert set(found) == set(plain(rows)) and all(len(best) == 20 for best in found.values())


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (40, None), (60, [nan, 1.0]), (80, [0.0, 0.0]), (100, [1.0, None]),
            (120, [inf, 0.0]), (140, []), (160, [3.0]), (180, [1.0, 2.0, 3.0]), (None, [5.0, 5.0]), (1, [0.5, 0.5]),
            (2, [-1e-30, 0.0]), (3, [1e20, 1.0]), (181, [1.0, 2.0, 3.0]), (0, [1.0, 0.0])]
    table = spark.createDataFrame([(*r, 1, "a") for r in rows], "vec_id long, embedding array<double>, q int, RANK string")
    close(shown(nb.nearest(table)), plain(rows))
    assert nb.nearest(table.limit(0)).collect() == []
    assert nb.nearest(table.filter("vec_id = 0")).collect() == []


def test_query_recall(spark, small_sf):
    rows = [(r.vec_id, r.embedding) for r in load_table(spark, small_sf, "embeddings").collect()]
    df = queries.op13_neighbours(spark, small_sf)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    assert recall(shown(df), plain(rows)) >= 0.95
