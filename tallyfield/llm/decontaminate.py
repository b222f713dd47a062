"""Benchmark decontamination: a prefix-filtered set join with exact verification.

A window is ``WINDOW`` consecutive words of a benchmark item, or all words of a shorter item; as a
set it consists of its shingles of two words (of its word, if it has one). Containment must be
whole, so one shingle is a sufficient prefix: every window is indexed by its rarest shingle alone,
by counts over all documents. Where a document holds that shingle, its place in the window fixes
where the window would start; what would not fit into the document is left out by these bounds, and
the rest is compared word by word.

Documents are not shuffled: the index travels to them. It is built from at most ``BLOCK_WINDOWS``
windows at a time, the proven bound of what is broadcast; a larger benchmark takes several passes
over the documents, whose findings are merged.

Cases. NULL and empty texts have no words; items without words have no windows. An item id that
repeats counts once; windows of items without an id mark words but name no item. Repeated documents
are all kept. Columns of the input are kept unless they clash with an added one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.tables import add_columns, row_slices, stored, thrifty

WINDOW = 10
BLOCK_WINDOWS = 500_000
ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")

# Bytes of words as they are, capitals as small letters, anything else as a space.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 32
    for b in range(256))
BOUNDARY = b"|"  # no word holds it


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (window, item): words joined by a space, and the item's id as text."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                starts = range(max(1, len(words) - WINDOW + 1)) if words else ()
                found = list({b" ".join(words[i:i + WINDOW]) for i in starts})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.decode("utf-8", "surrogatepass") for w in found], pa.string()),
                     pa.array([item] * len(found), pa.string())], names=["window", "item"])

    return benchmark.select(F.col(id_col).cast("string"), text_col) \
        .mapInArrow(thrifty(cut), "window string, item string").distinct()


class Windows:
    """Windows of one block as word numbers, and documents in the same numbers."""

    def __init__(self, found: list[tuple[str, list[str]]]):
        split = [w.encode("utf-8", "surrogatepass").split() for w, _ in found]
        self.items = [items for _, items in found]
        self.number = {w: i + 1 for i, w in enumerate(sorted({w for ws in split for w in ws}))}
        self.base = len(self.number) + 1
        self.number[BOUNDARY] = -1
        self.length = np.array([len(ws) for ws in split], np.int64)
        self.words = np.zeros((len(split), WINDOW), np.int64)
        for row, ws in zip(self.words, split, strict=True):
            row[:len(ws)] = [self.number[w] for w in ws]

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of all texts with -1 after each, where each text starts)."""
        parts = [(t or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES) for t in texts]
        words = (b" | ".join(parts) + b" |").split()
        numbers = np.fromiter(map(self.number.get, words, repeat(0)), np.int64, len(words))
        ends = np.flatnonzero(numbers < 0)
        return numbers, np.concatenate([[0], ends[:-1] + 1])

    def shingles(self, numbers: np.ndarray) -> np.ndarray:
        """Code of the two words from each position on; 0 where one is in no window."""
        codes = np.zeros(len(numbers), np.int64)
        first, second = numbers[:-1], numbers[1:]
        both = (first > 0) & (second > 0)
        codes[:-1][both] = first[both] * self.base + second[both]
        return codes

    def codes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code, window, offset) of every shingle of every window."""
        window, offset = np.nonzero((self.words[:, :-1] > 0) & (self.words[:, 1:] > 0))
        code = self.words[window, offset] * self.base + self.words[window, offset + 1]
        single = np.flatnonzero(self.length == 1)
        return (np.concatenate([code, self.words[single, 0] * self.base]),
                np.concatenate([window, single]), np.concatenate([offset, np.zeros(len(single), np.int64)]))


class Lookup:
    """Positions of known codes: a bit table first, the sorted codes for what passes it."""

    BITS = 22

    def __init__(self, codes: np.ndarray):
        self.codes = codes  # sorted, distinct
        self.table = np.zeros(1 << self.BITS, bool)
        self.table[self.slot(codes)] = True

    def slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).view(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``codes``, index of the known code) of all that are known."""
        at = np.flatnonzero(codes)
        at = at[self.table[self.slot(codes[at])]]
        if not len(at) or not len(self.codes):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        good = self.codes[k] == codes[at]
        return at[good], k[good]


def shingle_counts(texts: DataFrame, block: Windows) -> np.ndarray:
    """How often each distinct shingle code of the block occurs over all documents."""
    codes = np.unique(block.codes()[0])
    shared = texts.sparkSession.sparkContext.broadcast((block, codes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, codes = shared.value
        known, seen = Lookup(codes), np.zeros(len(codes), np.int64)
        singles = int((block.length == 1).any())
        for batch in batches:
            for part in row_slices(batch, 0):
                numbers, _ = block.read(part.column(0).to_pylist())
                for found in [block.shingles(numbers)] + [np.maximum(numbers, 0) * block.base] * singles:
                    seen += np.bincount(known.find(found)[1], minlength=len(codes))
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], names=["k", "n"])

    total = np.zeros(len(codes), np.int64)
    for row in texts.mapInArrow(thrifty(count), "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        total[row.k] = row.n
    return total


class Index:
    """Every window under its rarest shingle."""

    def __init__(self, block: Windows, counts: np.ndarray):
        self.block = block
        code, window, offset = block.codes()
        rare = counts[np.searchsorted(np.unique(code), code)]
        order = np.lexsort((offset, code, rare, window))
        first = order[np.flatnonzero(np.diff(window[order], prepend=-1))]
        first = first[np.argsort(code[first], kind="stable")]
        codes, starts = np.unique(code[first], return_index=True)
        self.window, self.offset = window[first], offset[first]
        self.starts = np.append(starts, len(first))
        self.known = Lookup(codes)
        self.singles = bool((block.length == 1).any())

    def find(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(starts of the texts, then first word and window of every occurrence, and all words)."""
        block = self.block
        numbers, begins = block.read(texts)
        found = [self.known.find(block.shingles(numbers))]
        if self.singles:
            found.append(self.known.find(np.maximum(numbers, 0) * block.base))
        at, k = (np.concatenate(x) for x in zip(*found, strict=True))
        many = self.starts[k + 1] - self.starts[k]
        entry = np.repeat(self.starts[k], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        window = self.window[entry]
        start = np.repeat(at, many) - self.offset[entry]
        fits = (start >= 0) & (start + block.length[window] <= len(numbers))
        start, window = start[fits], window[fits]
        for j in range(WINDOW):
            inside = j < block.length[window]
            same = ~inside | (numbers[np.minimum(start + j, len(numbers) - 1)] == block.words[window, j])
            start, window = start[same], window[same]
        return begins, start, window, numbers

    def scan(self, spans: list | None, items: list | None, texts: list[str | None]) -> list[list]:
        """Per text: number of words, merged hit spans (flat), ids of items found."""
        begins, start, window, numbers = self.find(texts)
        sizes = np.diff(np.append(begins, len(numbers))) - 1
        edge = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + self.block.length[window], -1)
        if spans is not None:
            for begin, old in zip(begins.tolist(), spans, strict=True):
                np.add.at(edge, begin + np.array(old[::2], np.int64), 1)
                np.add.at(edge, begin + np.array(old[1::2], np.int64), -1)
        hit = np.concatenate([[False], np.cumsum(edge)[:-1] > 0, [False]])
        turns = np.flatnonzero(hit[1:] != hit[:-1])
        owner = np.searchsorted(begins, turns[::2], side="right") - 1
        flat: list[list[int]] = [[] for _ in texts]
        for doc, a, b in zip(owner.tolist(), turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            flat[doc] += [a - int(begins[doc]), b - int(begins[doc])]
        named = [set(x) for x in items] if items is not None else [set() for _ in texts]
        pairs = np.unique(np.column_stack([np.searchsorted(begins, start, side="right") - 1, window]), axis=0)
        for doc, w in pairs.tolist():
            named[doc].update(self.block.items[w])
        return [sizes.tolist(), flat, [sorted(x) for x in named]]


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs``, or its columns ``keep``, with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``."""
    spark = docs.sparkSession
    found = stored(windows(benchmark), "benchmark-windows")
    blocks = max(1, math.ceil(found.count() / BLOCK_WINDOWS))
    kept = docs.drop(*ADDED)
    names = [f"_found_{k}" for k in range(2)]
    for number in range(blocks):
        part = found.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == number) \
            .groupBy("window").agg(F.collect_set("item").alias("items")).collect()
        block = Windows([(r.window, r["items"]) for r in sorted(part)])
        index = Index(block, shingle_counts(docs.select(text_col), block))
        shared = spark.sparkContext.broadcast(index)
        if number == 0:
            kept = add_columns(kept, [text_col], f"n_words long, {names[0]} array<int>, {names[1]} array<string>",
                               lambda shared=shared: lambda texts: shared.value.scan(None, None, texts),
                               keep if blocks == 1 else None)
        else:
            kept = add_columns(stored(kept, "decontaminate").drop("n_words"), [*names, text_col],
                               "n_words long, _more_0 array<int>, _more_1 array<string>",
                               lambda shared=shared: shared.value.scan).drop(*names) \
                .withColumnsRenamed({f"_more_{k}": names[k] for k in range(2)})
    spans, items = F.col(names[0]), F.col(names[1])
    n_hit = F.aggregate(F.sequence(F.lit(0), F.size(spans)), F.lit(0).cast("long"), lambda total, k: total + F.when(
        k == F.size(spans), 0).otherwise(F.when(k % 2 == 1, 1).otherwise(-1) * F.try_element_at(spans, k + 1)))
    return kept.withColumns({
        "n_hit": n_hit, "n_items": F.size(items).cast("long"),
        "items_sha256": F.sha2(F.array_join(items, ","), 256), "contaminated": F.size(spans) > 0,
    }).select(*(c for c in (docs.columns if keep is None else keep) if c not in ADDED), *ADDED)


# Every place of every document against every window of the same number of words.
ORACLE = r"""WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT item_id, least(len(w), 10) AS n, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0),
i AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM p),
s AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n),
q AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g FROM s),
h AS (SELECT doc_id, item_id, k, q.n AS n FROM q JOIN i ON q.g = i.g AND q.n = i.n),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""
