"""Decontamination against a plain search for every window."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyfield.llm import decontaminate as de
from tallyfield.llm import queries
from tallyfield.sources.tables import load_table

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    cut = []
    for item, text in items:
        w = words(text)
        cut += [(item, tuple(w[i:i + 10])) for i in range(max(1, len(w) - 9))] if w else []
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, window in cut:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i:i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found.update([item] * (item is not None))
        names = ",".join(sorted({str(i) for i in found}))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def shown(df):
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                   for r in df.collect()], key=repr)


@settings(deadline=None, max_examples=60)
@given(st.none() | st.text("aZ0é _-\x85 \n", max_size=40))
def test_words(text):
    assert [w.decode() for w in de.words_of(text)] == words(text)


LONG = "one two three four five six seven eight nine ten eleven twelve thirteen"
ITEMS = [
    (1, LONG), (2, "Short item"), (3, "solo"), (4, None), (5, " - "), (None, "nobody owns this"), (6, "short ITEM"),
    (6, "again six"), (7, "the the the the the the the the the the the the"), (10, LONG + " fourteen"),
]
DOCS = [
    (1, f"before {LONG} after"), (2, "x short, item! y solo z short"), (3, None), (4, ""), (4, "solo"), (4, "solo"),
    (5, "two three four five six seven eight nine ten eleven"), (6, "nobody owns this"), (None, "SOLO solo"),
    (7, "the " * 15), (8, "the " * 9), (9, "word " * 60_000 + LONG), (11, "short"), (12, "item"), (13, "one two three"),
]
SCHEMA = "doc_id long, text string, n_hit string, contaminated string"


@pytest.mark.parametrize("block", [3, 500_000])
def test_edge_rows_in_one_and_many_passes(spark, monkeypatch, block):
    monkeypatch.setattr(de, "BLOCK_WINDOWS", block)
    docs = spark.createDataFrame([(*r, "", "") for r in DOCS], SCHEMA).repartition(3)
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, window string")
    found = de.scan(docs, items)
    assert shown(found) == plain(DOCS, ITEMS)
    assert sorted(found.columns) == sorted({"doc_id", "text", *de.ADDED})


def test_empty_tables(spark):
    docs = spark.createDataFrame([(*r, "", "") for r in DOCS], SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert de.scan(docs.limit(0), items).count() == 0
    assert shown(de.scan(docs, items.limit(0))) == plain(DOCS, [])


@settings(deadline=None, max_examples=40)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14).map(" ".join), max_size=5),
       st.lists(st.lists(st.sampled_from("abcd"), max_size=40).map(" ".join), min_size=1, max_size=4))
def test_index_finds_every_window(items, docs):
    cut = sorted({" ".join(w[i:i + 10]) for w in map(words, items) for i in range(max(1, len(w) - 9)) if w})
    if not cut:
        return
    block = de.Windows([(w, [w]) for w in cut])
    counts = de.np.arange(len(de.np.unique(block.codes()[0])))
    _, spans, found = de.Index(block, counts).scan(None, None, docs)
    for doc, span, names in zip(docs, spans, found, strict=True):
        n_hit = plain([(0, doc)], [(w, w) for w in cut])[0][2]
        assert sum(span[1::2]) - sum(span[::2]) == n_hit
        assert names == sorted(w for w in cut if f" {w} " in f" {doc} ")


def test_query_equals_a_plain_search(spark, small_sf):
    docs = [tuple(r) for r in load_table(spark, small_sf, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in load_table(spark, small_sf, "benchmark").select("item_id", "text").collect()]
    found = shown(queries.op4_decontaminate(spark, small_sf))
    assert found == plain(docs, items) and any(r[-1] for r in found)
