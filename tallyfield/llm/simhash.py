"""SimHash near-duplicates by tiled exact comparison.

A fingerprint bit is the majority of that bit over the XXH64 hashes of all 4-word shingles. Equal
fingerprints become one. The distinct ones are cut into tiles of similar population counts, of the
whole fingerprint and of its lower half. A pair of tiles is compared (exclusive-or and bit counts
over whole tiles in numpy) unless the counts alone put every pair beyond the radius: flipping one
bit changes the count of exactly one half by one. No pair within the radius is lost.

A tile gives at most one edge per fingerprint, a spanning forest of the links inside it, and a pair
of tiles at most one per group that it joins, so groups of copies never become all their pairs; the
components are the same.

Cases. NULL texts and texts without words have fingerprint zero and link like any other. Repeated
rows and ids are kept. Where every id of a component is NULL its id is NULL. Tiles grow with the
number of distinct fingerprints once there are ``MOST_TILES``, so their list fits the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.components import components, local_roots
from tallyfield.llm.tables import add_columns, fresh, stored, thrifty

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
TILE = 4096
MOST_TILES = 2000
LOW_HALF = (1 << 32) - 1


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit fingerprint of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(SHINGLE_WORDS, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(
        starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist(), strict=True)], np.uint64)
    ones = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") \
        .sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", name: str = "fp", keep: list[str] | None = None) -> DataFrame:
    """``docs``, or its columns ``keep``, with the fingerprint as a signed 64-bit number."""
    def work(texts: list[str | None]) -> list:
        return [np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64).tolist()]

    return add_columns(docs, [text_col], f"`{name}` long", lambda: work, keep)


def tile_plan(cells: dict[tuple[int, int], int]) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Tiles (population, least and most of the lower half, slice, slices) for counted cells.

    Neighbouring cells of one population share a tile until it is full; a larger cell is sliced.
    """
    size = max(TILE, math.ceil(sum(cells.values()) / MOST_TILES))
    tiles: list[tuple[int, int, int, int, int]] = []
    for ones in sorted({p for p, _ in cells}):
        run: list[int] = []
        held = 0
        for low in sorted(k for p, k in cells if p == ones):
            n = cells[ones, low]
            if run and held + n > size:
                tiles.append((ones, run[0], run[-1], 0, 1))
                run, held = [], 0
            if n > size:
                slices = math.ceil(n / size)
                tiles += [(ones, low, low, i, slices) for i in range(slices)]
            else:
                run, held = [*run, low], held + n
        if run:
            tiles.append((ones, run[0], run[-1], 0, 1))
    return tiles, size


def near_tiles(tiles: list[tuple[int, int, int, int, int]], radius: int) -> np.ndarray:
    """Index pairs (i <= j) of tiles whose population counts allow a link."""
    if not tiles:
        return np.zeros((0, 2), np.int64)
    t = np.array(tiles)
    ones, low, high = t[:, 0], t[:, 1], t[:, 2]
    found = []
    for i in range(len(t)):
        def gap(a: np.ndarray, b: np.ndarray, a0: int, b0: int) -> np.ndarray:
            return np.maximum(0, np.maximum(a0 - b, a - b0))
        lower = gap(low[i:], high[i:], low[i], high[i])
        upper = gap(ones[i:] - high[i:], ones[i:] - low[i:], ones[i] - high[i], ones[i] - low[i])
        apart = np.maximum(lower + upper, abs(ones[i:] - ones[i]))
        j = np.flatnonzero(apart <= radius) + i
        found.append(np.column_stack([np.full(len(j), i), j]))
    return np.concatenate(found)


def tile_roots(a: np.ndarray, b: np.ndarray, roots: np.ndarray, shift: int, radius: int) -> np.ndarray:
    """``roots`` after adding the links between ``a`` (places from 0) and ``b`` (places from ``shift``)."""
    rows = max(1, (1 << 18) // max(1, len(b)))
    for start in range(0, len(a), rows):
        i, j = np.nonzero(np.bitwise_count(a[start:start + rows, None] ^ b[None, :]) <= radius)
        if len(i):
            roots = local_roots(roots, i + start, j + shift)
    return roots


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) edges that join all of the distinct fingerprints ``fp`` within the radius.

    Each tile is compared with itself first and carries what it is joined to inside; a pair of
    tiles then gives edges between such groups only, not between their members.
    """
    spark = prints.sparkSession
    low = F.bit_count(F.col("fp").bitwiseAND(F.lit(LOW_HALF)))
    cells = prints.select("fp", F.bit_count("fp").alias("ones"), low.alias("low"))
    counts = {(r.ones, r.low): r["count"] for r in cells.groupBy("ones", "low").count().collect()}
    tiles, _ = tile_plan(counts)
    pairs = near_tiles(tiles, radius)
    # At most 65 x 33 cells and a bounded number of tiles: small tables at any size of the input.
    places = [(ones, cell, first - s, n) for first, (ones, lo, hi, s, n) in enumerate(tiles)
              if s == 0 for cell in range(lo, hi + 1)]
    place = spark.createDataFrame(places, "ones int, low int, first long, slices int")
    tiled = cells.join(F.broadcast(place), ["ones", "low"]).select(
        "fp", (F.col("first") + F.pmod(F.xxhash64("fp"), F.col("slices"))).alias("tile"))

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                fps = batch.column(1)[k].values.to_numpy()
                unsigned = fps.view(np.uint64)
                roots = tile_roots(unsigned, unsigned, np.arange(len(fps)), 0, radius)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), pa.array([fps]), pa.array([roots])], names=["tile", "fps", "roots"])

    packed = stored(tiled.groupBy("tile").agg(F.collect_list("fp").alias("fps")).mapInArrow(
        inside, "tile long, fps array<long>, roots array<long>"), "simhash-tiles")
    within = packed.select("fps", F.explode(F.arrays_zip("fps", "roots")).alias("x")).select(
        F.col("x.fps").alias("a"), F.expr("fps[x.roots]").alias("b"))
    todo = spark.createDataFrame(pairs[pairs[:, 0] < pairs[:, 1]].tolist(), "i long, j long")

    def side(name: str) -> DataFrame:
        return packed.select(F.col("tile").alias(name), F.col("fps").alias(f"{name}_fps"), F.col("roots").alias(f"{name}_roots"))

    work = todo.join(side("i"), "i").join(side("j"), "j").select("i_fps", "i_roots", "j_fps", "j_roots")

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, a_roots, b, b_roots = (c[k].values.to_numpy() for c in batch.columns)
                values, before = np.concatenate([a, b]), np.concatenate([a_roots, b_roots + len(a)])
                after = tile_roots(a.view(np.uint64), b.view(np.uint64), before.copy(), len(a), radius)
                child = np.flatnonzero((before == np.arange(len(before))) & (after != before))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[child]), pa.array(values[after[child]])], names=["a", "b"])

    return within.filter("a <> b").unionAll(work.mapInArrow(thrifty(between), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) of every row."""
    rows = stored(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", keep=["id"]), "simhash")
    ids = least_by_component(rows, F.col("id"), radius)
    return rows.join(ids, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("least").alias("component_id"))


def least_by_component(rows: DataFrame, value: Column, radius: int) -> DataFrame:
    """(fp, least): for every fingerprint the smallest value in its component."""
    distinct = stored(rows.groupBy("fp").agg(F.min(value).alias("first")), "simhash-distinct")
    roots = stored(components(links(distinct, radius)), "simhash-roots") \
        .select(F.col("node").alias("fp"), "root")
    firsts = distinct.join(roots, "fp").groupBy("root").agg(F.min("first").alias("least"))
    return distinct.join(roots.join(firsts, "root"), "fp", "left").select(
        "fp", F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least")).alias("least"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, NULL last."""
    fp, row = fresh(docs.columns, "fp"), fresh(docs.columns, "row")
    marked = stored(fingerprints(docs, text_col, fp).withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    rows = marked.select(F.col(fp).alias("fp"), F.struct(
        F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row")).alias("key"))
    best = least_by_component(rows, F.col("key"), radius).select(F.col("least.row").alias(row)).distinct()
    return marked.join(best, row, "left_semi").select(*docs.columns)
