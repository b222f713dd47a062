"""Mixing: permutations, draws, targets, and what the mix takes of each document."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyfield.llm import mixing as mx
from tallyfield.llm import queries
from tallyfield.sources.tables import load_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(deadline=None, max_examples=80)
@given(st.integers(1, 3000), st.integers(0, 2**60))
def test_permutation_and_its_inverse(n, key):
    index = np.arange(n)
    there = mx.permute(index, n, key)
    assert sorted(there.tolist()) == index.tolist()
    assert np.array_equal(mx.permute(there, n, key, inverse=True), index)


@settings(deadline=None, max_examples=80)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=8))
def test_targets(sizes):
    named = {chr(97 + i): n for i, n in enumerate(sizes)}
    goal = mx.targets(named, 1.5, 2.0)
    assert sum(goal.values()) == pytest.approx(1.5 * sum(sizes))
    assert all(goal[s] <= 2 * named[s] + 1e-6 for s in named)
    open_ = [s for s in named if goal[s] < 2 * named[s] - 1e-6]
    rates = {round(goal[s] / mx.WEIGHTS[list(named).index(s) % 3], 6) for s in open_}
    assert len(rates) <= 1


@settings(deadline=None, max_examples=80)
@given(st.integers(1, 500), st.floats(0, 2), st.integers(1, 70), st.integers(0, 99))
def test_slots_give_the_target_exactly(words, times, block, key):
    slots, part, blocks = mx.slot_plan(words, times * words, key, block)
    total = Counter()
    for k in range(slots):
        at = int(mx.permute(np.array([k % blocks]), blocks, key + k // blocks)[0])
        length = min(block, words - at * block)
        total[at] += min(length, part) if part and k == slots - 1 else length
    assert sum(total.values()) == round(times * words)


def test_shards_use_every_slot_once():
    drawn = mx.draw_shards([7, 0, 100], mx.Recipe(shard_slots=10))
    seen = defaultdict(list)
    for _, s, first, n in drawn:
        seen[s] += range(first, first + n)
    assert {s: sorted(k) for s, k in seen.items()} == {0: list(range(7)), 2: list(range(100))}
    assert set(Counter(shard for shard, _, _, n in drawn for _ in range(n)).values()) <= {10, 7}


RECIPE = mx.Recipe(block_words=3, shard_slots=5)
SCHEMA = "doc_id long, text string, source string, n_chars int, row string, size string, s int"


def docs(spark):
    rows = [(ord(s) * 100 + i, " ".join(f"{s}{i}.{k}" for k in range(i % 11)), s, "", "", 0) for s in "abcd" for i in range(25)]
    rows += [(1, "same words here", None, "", "", 0)] * 3 + [(2, None, None, "", "", 0), (None, "no\nid  at all", "e", "", "", 0)]
    rows += [(90, "w " * 30_000, "f", "", "", 0), (3, "", "empty", "", "", 0)]
    return spark.createDataFrame([(r[0], r[1], r[2], len(r[1] or ""), *r[3:]) for r in rows], SCHEMA)


def test_taken_meets_targets_and_bounds(spark, monkeypatch):
    monkeypatch.setattr(mx, "CHUNK_ROWS", 7)
    table = docs(spark)
    found = mx.taken(table, RECIPE).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter(
        (r.doc_id, len(WORD.findall(r.text or ""))) for r in table.collect())
    source = {r.doc_id: r.source for r in table.collect()}
    goal = {source[r.doc_id]: r.target for r in found}
    assert sum(goal.values()) == pytest.approx(1.5 * sum(r.size for r in found))
    for name, target in goal.items():
        assert sum(r.taken for r in found if source[r.doc_id] == name) == round(target)
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    again = mx.taken(docs(spark).repartition(5), RECIPE).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))
    assert mx.taken(table.limit(0), RECIPE).count() == 0


def test_mixed_rows_hold_the_taken_words(spark):
    table = docs(spark)
    whole = defaultdict(list)
    for r in table.collect():
        whole[r.doc_id, r.source].append(r)
    rows = mx.mixed(table, RECIPE)
    assert rows.columns == table.columns
    got, count = defaultdict(Counter), Counter()
    for r in rows.collect():
        words = WORD.findall(r.text)
        assert r.n_chars == len(r.text) and words
        # The words of a row stand in the document in this order.
        rest = iter(WORD.findall(whole[r.doc_id, r.source][0].text))
        assert all(w in rest for w in words)
        got[r.doc_id, r.source].update(words)
        count[r.doc_id, r.source] += len(words)
    taken = Counter()
    for r in mx.taken(table.withColumn("doc_id", table.doc_id), RECIPE).collect():
        taken[r.doc_id] += r.taken
    by_id = Counter()
    for (doc, _), n in count.items():
        by_id[doc] += n
    assert by_id == Counter({k: v for k, v in taken.items() if v})


def test_query_near_targets(spark, sf):
    found = queries.op6_mixing(spark, sf).collect()
    source = {r.doc_id: r.source for r in load_table(spark, sf, "documents").select("doc_id", "source").collect()}
    taken, goal, size = Counter(), {}, Counter()
    for r in found:
        taken[source[r.doc_id]] += r.taken
        size[source[r.doc_id]] += r.size
        goal[source[r.doc_id]] = r.target
    assert all(taken[s] == round(goal[s]) for s in goal)
    assert goal == pytest.approx(mx.targets(dict(size), 1.5, 2.0))
