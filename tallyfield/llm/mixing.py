"""Mixing sources to target weights.

The words of a source, document after document, form one stream cut into blocks of ``block_words``
(the last one may be shorter). Output shards hold a fixed number of slots; how many of a shard's
slots each source gets is drawn, shard by shard, from what the sources still have to give: a
multinomial draw without replacement, so the totals meet the targets. The k-th slot of a source
takes the block to which a pseudorandom permutation of the source's block numbers maps k; after all
blocks have been taken once, the next permutation starts. Slots and documents meet in a join on
(source, block).

Targets. Sources by code point, NULL last, have the weights 3, 1, 2, repeating. Together they get
``share`` of all words; no source more than ``most`` times its own, the excess going to the others
by weight. The last slot of a source takes only as many words of its block as its target lacks.

Order and draws depend on document ids, texts, source names and the seed, not on partitions, so
reruns agree. A hot source is cut into chunks by a hash before its running totals are formed.

Cases. NULL, empty and word-free texts have size 0 and are never taken. A NULL source is a source.
Repeated rows are documents of their own. Sources without words have target 0. The list of sources
is the mix's recipe and is held by the driver, as is the table of slots per shard and source, of
which there are at most ``MOST_SHARDS`` shards.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.llm.tables import fresh, row_slices, stored, thrifty

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
MOST_SHARDS = 10_000
CHUNK_ROWS = 20_000
ROUNDS = 4


@dataclass(frozen=True)
class Recipe:
    share: float = 1.5
    most: float = 2.0
    block_words: int = 64
    shard_slots: int = 4096
    seed: int = 0


def targets(sizes: dict[str | None, int], share: float, most: float) -> dict[str | None, float]:
    """Words that the mix takes of each source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {name: WEIGHTS[i % len(WEIGHTS)] for i, name in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        full = [s for s in names if s in open_ and left * weight[s] / whole > most * sizes[s]]
        if not full:
            return {s: out[s] if s in out else left * weight[s] / whole for s in names}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def scramble(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit mixing function."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64(key % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """Where a pseudorandom permutation of 0 .. n-1 puts each index, or what it puts there.

    A Feistel network over the next even power of two; what falls beyond n goes through again.
    """
    half = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    keys = [key * ROUNDS + r for r in range(ROUNDS)]
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in (keys[::-1] if inverse else keys):
            if inverse:
                left, right = right ^ (scramble(left, k) & mask), left
            else:
                left, right = right, left ^ (scramble(right, k) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def source_key(name: str | None, seed: int) -> int:
    return xxhash.xxh64_intdigest(repr(name), seed=seed) >> 8


def slot_plan(words: int, target: float, key: int, block: int) -> tuple[int, int, int]:
    """(slots, words of the last slot or 0 if it is whole, blocks) that give a source its target."""
    blocks = math.ceil(words / block)
    if not words:
        return 0, 0, 0
    epochs, rest = divmod(round(target), words)
    short = words - (blocks - 1) * block
    at = int(permute(np.array([blocks - 1]), blocks, key + epochs, inverse=True)[0])
    if rest <= at * block:
        full, part = divmod(rest, block)
    elif rest <= at * block + short:
        full, part = at, rest - at * block
        full, part = (full + 1, 0) if part == short else (full, part)
    else:
        full, part = divmod(rest - short, block)
        full += 1
    return epochs * blocks + full + (part > 0), part, blocks


def draw_shards(slots: list[int], recipe: Recipe) -> list[tuple[int, int, int, int]]:
    """(shard, source number, first slot of the source, slots) of every shard and source."""
    left = np.array(slots, np.int64)
    size = max(recipe.shard_slots, math.ceil(left.sum() / MOST_SHARDS))
    rng = np.random.default_rng(recipe.seed)
    given = np.zeros_like(left)
    out = []
    shard = 0
    while left.sum():
        n = min(size, int(left.sum()))
        drawn = rng.multivariate_hypergeometric(left, n, method="marginals")
        out += [(shard, s, int(given[s]), int(drawn[s])) for s in np.flatnonzero(drawn).tolist()]
        given += drawn
        left -= drawn
        shard += 1
    return out


SLOT = T.StructType([T.StructField(name, T.LongType()) for name in ("s", "shard", "epoch", "block", "words")])


def plan(rows: DataFrame, recipe: Recipe) -> tuple[DataFrame, DataFrame]:
    """(one row per source: its number, size, target and chunks; one row per slot)."""
    spark = rows.sparkSession
    sources = {r.source: r for r in rows.groupBy("source").agg(
        F.sum("size").alias("words"), F.count("*").alias("n")).collect()}
    names = sorted(sources, key=lambda s: (s is None, s or ""))
    goal = targets({s: sources[s].words for s in names}, recipe.share, recipe.most)
    keys = [source_key(s, recipe.seed) for s in names]
    planned = [slot_plan(sources[s].words, goal[s], k, recipe.block_words) for s, k in zip(names, keys, strict=True)]
    recipe_rows = [(i, s, sources[s].words, float(goal[s]), math.ceil(sources[s].n / CHUNK_ROWS))
                   for i, s in enumerate(names)]
    table = spark.createDataFrame(
        recipe_rows, "s long, source string, source_size long, target double, chunks int")
    shards = spark.createDataFrame(
        draw_shards([p[0] for p in planned], recipe), "shard long, s long, first long, slots long")
    block = recipe.block_words

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, s, first, many in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                slots, part, blocks = planned[s]
                k = np.arange(first, first + many)
                epoch, index = k // blocks, k % blocks
                taken = np.empty(many, np.int64)
                for e in np.unique(epoch).tolist():
                    taken[epoch == e] = permute(index[epoch == e], blocks, keys[s] + e)
                words = np.full(many, block)
                if part:
                    words[k == slots - 1] = part
                columns = [np.full(many, s), np.full(many, shard), epoch, taken, words]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=SLOT.names)

    return table, shards.mapInArrow(thrifty(fill), SLOT)


def pieces(rows: DataFrame, table: DataFrame, slots: DataFrame, recipe: Recipe) -> DataFrame:
    """(row, epoch, a, b): the words a to before b of a row that one slot takes."""
    block = recipe.block_words
    spread = rows.filter("size > 0").join(table, rows.source.eqNullSafe(table.source)).select(
        "row", "s", "size", F.pmod(F.xxhash64("id", "digest"), F.col("chunks")).alias("chunk"), "id", "digest")
    chunk = spread.groupBy("s", "chunk").agg(F.sum("size").alias("n"))
    before = chunk.select("s", "chunk", (F.sum("n").over(
        Window.partitionBy("s").orderBy("chunk")) - F.col("n")).alias("base"))
    inside = F.sum("size").over(Window.partitionBy("s", "chunk").orderBy("id", "digest", "row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    placed = spread.withColumn("inside", inside).join(before, ["s", "chunk"]).select(
        "row", "s", "size", (F.col("base") + F.col("inside")).alias("at"))
    start, end = F.col("at"), F.col("at") + F.col("size")
    cut = placed.select("row", "s", "at", "size", F.explode(F.sequence(
        (start / block).cast("long"), ((end - 1) / block).cast("long"))).alias("block"))
    low = F.greatest(F.col("block") * block, start)
    return cut.join(slots, ["s", "block"]).select(
        "row", "epoch", (low - start).alias("a"),
        (F.least(end, F.col("block") * block + F.col("words")) - start).alias("b")).filter("a < b")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: str) -> DataFrame:
    """Rows numbered and measured, written once so that the numbers stay."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"),
        F.col(source_col).alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), *more), "mixing")


def taken(docs: DataFrame, recipe: Recipe = Recipe(), id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken) of every row; ``taken`` counts repeated words."""
    rows = sized(docs, id_col, text_col, source_col)
    table, slots = plan(rows, recipe)
    sums = pieces(rows, table, slots, recipe).groupBy("row").agg(F.sum(F.col("b") - F.col("a")).alias("taken"))
    return rows.join(table, rows.source.eqNullSafe(table.source)).join(sums, "row", "left").select(
        F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed(docs: DataFrame, recipe: Recipe = Recipe(), id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """The mix itself: per document and epoch a row of ``docs`` with the words that were taken.

    A document that is taken twice gives two rows. Words that were taken in a row keep the white
    space between them; runs are joined by a line feed. ``n_chars``, if there, is counted again.
    """
    whole = fresh(["row", "id", "digest", "source", "size"], "whole")
    rows = sized(docs.withColumn(whole, F.struct(*(F.col(c) for c in docs.columns))),
                 id_col, text_col, source_col, whole)
    table, slots = plan(rows.drop(whole), recipe)
    runs = pieces(rows.drop(whole), table, slots, recipe).groupBy("row", "epoch").agg(
        F.sort_array(F.collect_list(F.struct("a", "b"))).alias("runs"))
    parts = rows.select("row", f"{whole}.*").toDF("row_number", *[f"c{i}" for i in range(len(docs.columns))]) \
        .join(runs.withColumnRenamed("row", "row_number"), "row_number").drop("row_number", "epoch")
    names = docs.columns
    at = {name: i for i, name in enumerate(names)}
    schema = docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, at[text_col]):
                columns = list(part.columns)[:len(names)]
                texts = [keep(t, [(r["a"], r["b"]) for r in runs]) for t, runs in zip(
                    columns[at[text_col]].to_pylist(), part.column(len(names)).to_pylist(), strict=True)]
                columns[at[text_col]] = pa.array(texts, columns[at[text_col]].type)
                if "n_chars" in at:
                    columns[at["n_chars"]] = pa.array([len(t) for t in texts]).cast(columns[at["n_chars"]].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return parts.mapInArrow(thrifty(cut), schema)


def keep(text: str, runs: list[tuple[int, int]]) -> str:
    """The words of sorted runs (a to before b), adjacent runs joined as they stand in the text."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    blank = (code == 32) | ((code >= 9) & (code <= 13))
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    ends = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    merged: list[list[int]] = []
    for a, b in runs:
        if merged and merged[-1][1] == a:
            merged[-1][1] = b
        else:
            merged.append([a, b])
    if merged == [[0, len(starts)]]:
        return text
    return "\n".join(text[starts[a]:ends[b - 1]] for a, b in merged)
