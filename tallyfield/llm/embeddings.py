"""Near-duplicate vectors: 8-bit products decide, full precision confirms.

Every vector is scaled to unit length and rounded to signed 8-bit steps of its own size; the length
of what rounding took away bounds how far any product with it can be off: for unit u with rounded
form r and error e = |u - r|, |u.v - r_u.r_v| <= e_u + (1 + e_u) e_v. Tiles of vectors are multiplied
in 8-bit steps (held in a float type that is exact for such sums); only pairs whose product plus
bound reaches the threshold are computed again in double precision.

Equal vectors become one with a count. A pair of tiles gives one row per linked vector: how many
vectors it found and one spanning edge, so groups of copies never become all their pairs.

Cases. A vector that is NULL, empty, zero, or holds a NULL or non-finite component links with
nothing and is its own component. Vectors of different lengths do not link. Repeated rows link with
each other. NULL ids are kept; the smallest id of a component ignores them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.components import components, local_roots
from tallyfield.llm.tables import stored

THRESHOLD = 0.9
# A tile holds a twelfth of the vectors within these limits: enough pairs of tiles to spread a
# small table, and few enough copies of each tile for a large one.
TILE_LIMITS = (1024, 32768)
PARTS = 12
# float32 holds the sums of so many products of two 8-bit numbers exactly.
EXACT_DIMS = (1 << 24) // (127 * 127)
ROUNDING = 1e-6  # above the float32 rounding of two scalings


def usable(vector: Column) -> Column:
    """Not NULL, not empty, all components finite, one of them not zero."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


class Tile:
    """Vectors with their 8-bit forms."""

    def __init__(self, nodes: np.ndarray, counts: np.ndarray, vectors: np.ndarray):
        self.nodes, self.counts = nodes, counts
        exact = vectors.astype(np.float64)
        # Dividing by the largest component first keeps tiny and huge vectors finite.
        exact = exact / np.abs(exact).max(axis=1, keepdims=True)
        self.unit = exact / np.sqrt((exact * exact).sum(axis=1, keepdims=True))
        self.step = np.abs(self.unit).max(axis=1) / 127
        codes = np.rint(self.unit / self.step[:, None]).astype(np.int8)
        kept = codes * self.step[:, None]
        self.error = np.sqrt(((self.unit - kept) ** 2).sum(axis=1)) * (1 + 1e-9)
        self.codes = codes.astype(np.float32 if codes.shape[1] <= EXACT_DIMS else np.float64)


def tile_links(a: Tile, b: Tile, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, links found, spanning neighbour) of every node linked between the tiles."""
    nodes = a.nodes if same else np.concatenate([a.nodes, b.nodes])
    shift = 0 if same else len(a.nodes)
    found = np.zeros(len(nodes), np.int64)
    roots = np.arange(len(nodes))
    codes_b = np.ascontiguousarray(b.codes.T)
    rows = max(1, (1 << 20) // max(1, len(b.nodes)))
    for start in range(0, len(a.nodes), rows):
        part = slice(start, start + rows)
        about = (a.codes[part] @ codes_b) * a.step[part, None].astype(np.float32) * b.step.astype(np.float32)
        slack = a.error[part, None] + (1 + a.error[part, None]) * b.error + ROUNDING
        i, j = np.nonzero(about >= (threshold - slack))
        i = i + start
        if same:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), 1 << 15):
            p, q = i[at:at + (1 << 15)], j[at:at + (1 << 15)]
            sure = np.einsum("ij,ij->i", a.unit[p], b.unit[q]) >= threshold
            p, q = p[sure], q[sure]
            found += np.bincount(p, b.counts[q], len(nodes)).astype(np.int64)
            found += np.bincount(q + shift, a.counts[p], len(nodes)).astype(np.int64)
            roots = local_roots(roots, p, q + shift)
    linked = np.flatnonzero(found)
    return nodes[linked], found[linked], nodes[roots[linked]]


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) of every row of ``table``."""
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    distinct = stored(rows.filter(usable(F.col("vector"))).groupBy("vector").agg(
        F.min("id").alias("first"), F.count("*").alias("copies")).select(
        F.monotonically_increasing_id().alias("node"), "first", "copies", "vector"), "embeddings")
    sizes = {r.dims: r["count"] for r in distinct.groupBy(F.size("vector").alias("dims")).count().collect()}
    total = sum(sizes.values())
    low, high = TILE_LIMITS
    tiles = max(1, math.ceil(total / min(max(low, math.ceil(total / PARTS)), high)))
    place = F.pmod(F.xxhash64("node"), F.lit(tiles))
    packed = distinct.select(
        F.size("vector").alias("dims"), place.alias("tile"), F.struct("node", "copies", "vector").alias("row")) \
        .groupBy("dims", "tile").agg(F.collect_list("row").alias("rows"))
    todo = table.sparkSession.range(tiles).select(
        F.col("id").alias("i"), F.explode(F.sequence("id", F.lit(tiles - 1).cast("long"))).alias("j"))
    work = todo.join(packed.select("dims", F.col("tile").alias("i"), F.col("rows").alias("left")), "i") \
        .join(packed.select("dims", F.col("tile").alias("j"), F.col("rows").alias("right")), ["dims", "j"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                i, j = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                left = tile(batch.column(2)[k])
                right = left if i == j else tile(batch.column(3)[k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in tile_links(left, right, i == j, threshold)], names=["node", "n", "near"])

    def tile(rows: pa.Scalar) -> Tile:
        node, copies, vector = rows.values.flatten()
        return Tile(node.to_numpy(), copies.to_numpy(),
                    vector.flatten().to_numpy(zero_copy_only=False).reshape(len(node), -1))

    found = stored(work.select("i", "j", "left", "right").mapInArrow(compare, "node long, n long, near long"),
                   "embedding-links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = stored(components(found, "node", "near"), "embedding-roots")
    firsts = distinct.select("node", "first").join(roots, "node").groupBy("root").agg(F.min("first").alias("least"))
    known = distinct.join(counts, "node", "left").join(roots.join(firsts, "root"), "node", "left").select(
        F.col("vector"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least")).alias("component"))
    # Rows that link with nothing have no partner here; a NULL vector equals none.
    return rows.join(known, "vector", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


# Every pair in double precision, and what each vector reaches over the links.
ORACLE = """WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT a AS x, b AS y FROM l UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a),
c AS (SELECT x, min(y) AS low FROM r GROUP BY x),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.x = vec_id"""
