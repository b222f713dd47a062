"""SimHash: fingerprints and components against plain versions."""

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from brute import classes, smallest_ids
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyfield.llm import queries
from tallyfield.llm import simhash as sh
from tallyfield.llm.components import components, local_roots, spanning
from tallyfield.sources.tables import load_table


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    size = min(4, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i:i + size]).encode(), seed=42).intdigest()
              for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(deadline=None, max_examples=80)
@given(st.none() | st.text("abÀÉ  \n\t\x1c ", max_size=60))
def test_fingerprint(text):
    assert sh.fingerprint(text) == plain_fingerprint(text)


def test_hash_equals_the_session_function(spark):
    text = "ein zwei drei vier"
    found = spark.sql(f"select xxhash64('{text}') as h").first().h
    assert found % 2**64 == sh.fingerprint(text)


@settings(deadline=None, max_examples=40)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_local_roots(pairs):
    left, right = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    assert local_roots(np.arange(31), left, right).tolist() == classes(31, pairs)


@settings(deadline=None, max_examples=40)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_spanning_forest(pairs):
    left, right = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    child, root = spanning(left, right)
    assert classes(31, list(zip(child.tolist(), root.tolist(), strict=True))) == classes(31, pairs)
    assert len(set(child.tolist())) == len(child)


def near_prints(rng, n):
    """Random fingerprints, each with some at a few bits from it."""
    prints = []
    for _ in range(n):
        base = int(rng.integers(0, 2**63)) * 2 + int(rng.integers(0, 2))
        prints.append(base)
        for _ in range(int(rng.integers(0, 4))):
            for bit in rng.integers(0, 64, int(rng.integers(1, 7))):
                base ^= 1 << int(bit)
            prints.append(base)
    return prints


@pytest.mark.parametrize("tile", [4, 64, 4096])
def test_links_join_every_component(spark, monkeypatch, tile):
    monkeypatch.setattr(sh, "TILE", tile)
    prints = sorted(set(near_prints(np.random.default_rng(tile), 120)))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    found = sh.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    at = {x: i for i, x in enumerate(signed)}
    near = [(i, j) for (i, a), (j, b) in combinations(enumerate(prints), 2) if (a ^ b).bit_count() <= 4]
    assert near
    assert classes(len(prints), [(at[r.a], at[r.b]) for r in found]) == classes(len(prints), near)


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 3000)]
    pairs = path + star + [(9, 9), (1, 2), (2, 1)]
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(1000, 3000)}, 1: 1, 2: 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


SCHEMA = "doc_id long, text string, fp string, component_id int, tile int"


def test_edge_rows(spark):
    rows = [(4, "a b c d e", "x", 1, 1), (3, "A  b\nc d E", "x", 1, 1), (3, "A  b\nc d E", "x", 1, 1), (9, None, "", 0, 0),
            (8, "", "", 0, 0), (None, " \n", "", 0, 0), (None, "alone here", "", 0, 0), (5, "w " * 40_000, "", 0, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: tuple(map(repr, r))
    found = sorted([(r.doc_id, r.fingerprint, r.component_id) for r in sh.near_duplicates(docs).collect()], key=key)
    prints = [plain_fingerprint(r[1]) for r in rows]
    linked = [(i, j) for i, j in combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= 4]
    ids = smallest_ids([r[0] for r in rows], linked)
    assert found == sorted([(r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, ids, strict=True)], key=key)
    assert sh.near_duplicates(docs.limit(0)).count() == 0


def test_query_equals_all_pairs(spark, small_sf):
    docs = load_table(spark, small_sf, "documents").select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in docs]
    linked = [(i, j) for i, j in combinations(range(len(docs)), 2) if (prints[i] ^ prints[j]).bit_count() <= 4]
    ids = smallest_ids([r.doc_id for r in docs], linked)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op8_simhash(spark, small_sf).collect()}
    assert found == {r.doc_id: (f"{p:016x}", c) for r, p, c in zip(docs, prints, ids, strict=True)}
