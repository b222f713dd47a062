"""Near-duplicate vectors against all pairs in double precision."""

import math

import numpy as np
import pytest
from brute import smallest_ids
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyfield.llm import embeddings as em
from tallyfield.llm import queries
from tallyfield.sources.tables import load_table


def plain(rows, threshold=0.9):
    """(id, n_links, component_id, kept) over all pairs."""
    def good(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if good(v) else None for _, v in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if units[i] is not None and units[j] is not None
              and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold]
    n = np.zeros(len(rows), int)
    for pair in linked:
        n[list(pair)] += 1
    ids = smallest_ids([r[0] for r in rows], linked)
    return [(r[0], int(k), c, r[0] is not None and r[0] == c) for r, k, c in zip(rows, n, ids, strict=True)]


def clusters(rng, groups, dims):
    out = []
    for _ in range(groups):
        centre = rng.normal(size=dims)
        out += [(centre + rng.normal(size=dims) * s).astype(np.float32).tolist() for s in rng.uniform(0, 0.7, 6)]
    return out


def shown(df):
    return sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()], key=repr)


@settings(deadline=None, max_examples=60)
@given(st.integers(0, 10**6), st.integers(1, 80))
def test_the_bound_holds(seed, dims):
    rng = np.random.default_rng(seed)
    vectors = (rng.normal(size=(12, dims)) * 10.0 ** rng.integers(-20, 20, (12, 1))).astype(np.float32)
    vectors[:, 0] += vectors[:, 0] == 0
    tile = em.Tile(np.arange(12), np.ones(12, np.int64), vectors)
    about = (tile.codes @ tile.codes.T) * tile.step[:, None] * tile.step
    off = np.abs(about - tile.unit @ tile.unit.T)
    assert (off <= tile.error[:, None] + (1 + tile.error[:, None]) * tile.error + em.ROUNDING).all()


@pytest.mark.parametrize("limits", [(8, 16), (1024, 32768)])
def test_equals_all_pairs(spark, monkeypatch, limits):
    monkeypatch.setattr(em, "TILE_LIMITS", limits)
    rng = np.random.default_rng(1)
    vectors = clusters(rng, 12, 16)
    rows = [(100 - i, v) for i, v in enumerate(vectors)] + [(500 + i, vectors[3]) for i in range(9)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert shown(em.near_duplicates(table)) == sorted(plain(rows), key=repr)


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [inf, 1.0]), (5, [nan, 1.0]), (6, []), (7, [2.0, 0.0]),
            (8, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.1]), (None, [0.0, 1.0]),
            (10, [0.0, -1e-30]), (11, [0.0, -1e30]), (12, None), (13, [0.9, math.sqrt(1 - 0.81)])]
    table = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    narrow = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert shown(em.near_duplicates(table)) == sorted(plain(narrow), key=repr)
    assert em.near_duplicates(table.limit(0)).count() == 0


def test_query_equals_all_pairs(spark, small_sf):
    rows = [(r.vec_id, r.embedding) for r in load_table(spark, small_sf, "embeddings").collect()]
    assert shown(queries.op3_embedding_dedup(spark, small_sf)) == sorted(plain(rows), key=repr)
