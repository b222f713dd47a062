"""Nearest vectors by inner product: multi-index hashing of learned rotated binary codes.

Candidates x get one more entry, sqrt(M^2 - |x|^2) for the largest length M, and queries a 0: among
these the nearest by distance is the one with the largest inner product. On a bounded sample the
axes of largest variance are found and rotated until signs lose least (iterative quantisation). The
signs are a vector's code. A code is cut into m substrings. If two codes differ in r bits at most,
then, by the pigeonhole principle, some substring of them differs in r // m bits at most, and in one
bit less unless it is among the first r % m + 1. So probing every substring's index with all keys so
near to the query's retrieves every code within the radius r; what is retrieved is compared in full
and ranked by its inner product in double precision.

The radius is learned too: it covers all but ``MISSED`` of the nearest neighbours of sample rows
within the sample. Neighbours among all rows are nearer than those, so the recall is that or more.
A query that retrieves too few is searched again with the radius of all bits, which is exact.

Equal vectors become one node that keeps its smallest ids, one more than a query returns. Nodes are
dealt by a hash to blocks of bounded size, each with its own index, so that no group of near copies
fills one task; every query meets every block, in tiles, and brings back its best of each.

Cases. Vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part, as do
rows with a NULL id. Vectors of different lengths are no candidates for each other. Repeated rows
count once; a row with the query's own id is never its candidate. Equal scores are ranked by id. An
empty table gives no rows. Only the two named columns are read, so others may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.llm.embeddings import usable
from tallyfield.llm.tables import stored

NEAREST = 20
EVERY = 20
# Rows that the rotation and the radius are learned from, and those of them that serve as queries.
SAMPLE = 8192
SAMPLE_QUERIES = 512
MISSED = 0.02
MOST_BITS = 64
ROTATIONS = 30
SEED = 5
# A block holds a twelfth of the nodes within these limits, a tile of queries likewise.
BLOCK_LIMITS = (1024, 16384)
PARTS = 12
# Codes that a substring's key should meet in a block.
BUCKET = 32
# Queries that are scored at once.
CHUNK = 256
# Above the rounding of an inner product in any order of addition, relative to the lengths.
ROUNDING = 1e-12


@dataclass(frozen=True)
class Model:
    """Codes of the vectors of one length."""

    largest: float  # length of the longest vector
    mean: np.ndarray
    axes: np.ndarray  # columns: rotated directions
    radius: int

    @property
    def bits(self) -> int:
        return self.axes.shape[1]

    def codes(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """The signs of every row, packed into unsigned 64-bit numbers."""
        signs = (placed(vectors, self.largest, query) - self.mean) @ self.axes >= 0
        weights = np.left_shift(np.uint64(1), np.arange(self.bits, dtype=np.uint64))
        return (signs * weights).sum(axis=1, dtype=np.uint64)


def placed(vectors: np.ndarray, largest: float, query: bool) -> np.ndarray:
    """Vectors with the entry that makes distances follow inner products."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True) if query else vectors / largest
    squares = (scaled * scaled).sum(axis=1, keepdims=True)
    if query:
        return np.column_stack([scaled / np.sqrt(squares), np.zeros(len(scaled))])
    return np.column_stack([scaled, np.sqrt(np.maximum(1 - squares, 0))])


def learn(vectors: np.ndarray, largest: float, nearest: int) -> Model:
    """Rotation and radius from sample rows."""
    rng = np.random.default_rng(SEED)
    points = placed(vectors, largest, False)
    mean = points.mean(axis=0)
    centred = points - mean
    spread, directions = np.linalg.eigh(centred.T @ centred)
    bits = min(MOST_BITS, vectors.shape[1])
    top = directions[:, np.argsort(-spread)[:bits]]
    flat = centred @ top
    turn = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(ROTATIONS):
        signs = np.where(flat @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(flat.T @ signs)
        turn = left @ right
    model = Model(largest, mean, top @ turn, bits)
    asked = rng.permutation(len(vectors))[:SAMPLE_QUERIES]
    codes, queries = model.codes(vectors, False), model.codes(vectors[asked], True)
    scores = vectors[asked] @ vectors.T
    scores[np.arange(len(asked)), asked] = -np.inf
    k = min(nearest, len(vectors) - 1)
    if k < 1:
        return model
    best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    apart = np.bitwise_count(codes[best] ^ queries[:, None])
    return Model(largest, mean, model.axes, int(np.quantile(apart, 1 - MISSED, method="higher")))


class Index:
    """The substring tables of one block."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.codes = codes
        width = min(16, max(4, round(math.log2(max(1, len(codes)) / BUCKET))))
        bounds = np.linspace(0, bits, math.ceil(bits / width) + 1).round().astype(int).tolist()
        self.cuts = [(a, b - a) for a, b in zip(bounds, bounds[1:])]
        self.tables = []
        for start, size in self.cuts:
            keys = self.keys(codes, start, size)
            order = np.argsort(keys, kind="stable")
            self.tables.append((order, np.searchsorted(keys[order], np.arange((1 << size) + 1))))

    @staticmethod
    def keys(codes: np.ndarray, start: int, size: int) -> np.ndarray:
        return ((codes >> np.uint64(start)) & np.uint64((1 << size) - 1)).astype(np.int64)

    def within(self, queries: np.ndarray, radius: int) -> np.ndarray:
        """Boolean matrix: which codes each query retrieves, all that differ in ``radius`` bits at most."""
        found = np.zeros((len(queries), len(self.codes)), bool)
        least, more = divmod(radius, len(self.cuts))
        for number, (start, size) in enumerate(self.cuts):
            reach = least if number <= more else least - 1
            if reach < 0:
                continue
            every = np.arange(1 << size)
            ball = every[np.bitwise_count(every) <= reach]
            order, begins = self.tables[number]
            keys = self.keys(queries, start, size)
            for key in np.unique(keys):
                rows = slots(order, begins, ball ^ key)
                asking = np.flatnonzero(keys == key)
                near = np.bitwise_count(self.codes[rows] ^ queries[asking, None]) <= radius
                found[asking[:, None], rows] |= near
        return found


def slots(order: np.ndarray, begins: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Rows filed under any of the keys."""
    counts = begins[keys + 1] - begins[keys]
    keys, counts = keys[counts > 0], counts[counts > 0]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return order[np.repeat(begins[keys] - (ends - counts), counts) + np.arange(total)]


def best_of(queries: np.ndarray, vectors: np.ndarray, place: np.ndarray, found: np.ndarray,
            most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the ``most`` highest found rows of every query; ``place`` orders equal scores."""
    with np.errstate(over="ignore", invalid="ignore"):
        scores = np.where(found, queries @ vectors.T, -np.inf)
    if scores.shape[1] > most:
        cut = np.partition(scores, scores.shape[1] - most, axis=1)[:, -most, None]
        longest = np.linalg.norm(vectors, axis=1).max(initial=0)
        cut = cut - ROUNDING * np.linalg.norm(queries, axis=1)[:, None] * longest
        q, row = np.nonzero(found & (scores >= cut))
    else:
        q, row = np.nonzero(found)
    # The sum of one row's products is the same wherever the row lies; a matrix product's is not.
    exact = np.concatenate([(queries[q[at:at + 65536]] * vectors[row[at:at + 65536]]).sum(axis=1)
                            for at in range(0, len(q), 65536)] or [np.zeros(0)])
    order = np.lexsort((place[row], -exact, q))
    q, row, exact = q[order], row[order], exact[order]
    kept = np.arange(len(q)) - np.searchsorted(q, q) < most
    return q[kept], row[kept], exact[kept]


def pack(nodes: DataFrame, place: Column, columns: list[str], name: str) -> DataFrame:
    """(dims, place, lists): nodes gathered by place."""
    return nodes.groupBy("dims", place.alias(name)).agg(*[F.collect_list(F.struct(*columns)).alias(f"{name}_rows")])


def parts(total: int) -> int:
    low, high = BLOCK_LIMITS
    return max(1, math.ceil(total / min(max(low, math.ceil(total / PARTS)), high)))


def search(nodes: DataFrame, asking: DataFrame, models: dict[int, Model], total: int, n_asking: int, most: int,
           whole: bool) -> DataFrame:
    """(q, node, score): the best nodes of every asking node, of each block. ``whole`` takes the radius of all bits."""
    blocks, tiles = parts(total), parts(n_asking)
    columns = ["node", "first", "vector"]
    left = pack(asking, F.pmod(F.xxhash64("node", F.lit(1)), F.lit(tiles)), columns, "tile")
    right = pack(nodes, F.pmod(F.xxhash64("node"), F.lit(blocks)), columns, "block")
    todo = nodes.sparkSession.range(tiles).select(
        F.col("id").alias("tile"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    work = todo.join(left, "tile").join(right, ["dims", "block"]).select("dims", "tile_rows", "block_rows")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                model = models[batch.column(0)[k].as_py()]
                (q_nodes, _, queries), (r_nodes, firsts, vectors) = (rows_of(batch.column(c)[k]) for c in (1, 2))
                place = np.argsort(np.argsort(firsts.to_numpy(zero_copy_only=False), kind="stable"))
                index = Index(model.codes(vectors, False), model.bits)
                codes = model.codes(queries, True)
                for at in range(0, len(queries), CHUNK):
                    part = slice(at, at + CHUNK)
                    found = index.within(codes[part], model.bits if whole else model.radius)
                    q, row, score = best_of(queries[part], vectors, place, found, most)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_nodes[part][q]), pa.array(r_nodes[row]), firsts.take(pa.array(row)), pa.array(score)],
                        names=["q", "node", "first", "score"])

    id_type = nodes.schema["first"].dataType.simpleString()
    return work.mapInArrow(compare, f"q long, node long, first {id_type}, score double")


def rows_of(rows: pa.Scalar) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(nodes, smallest ids, vectors) of a packed list."""
    node, first, vector = rows.values.flatten()
    return node.to_numpy(), first, vector.flatten().to_numpy(zero_copy_only=False).reshape(len(node), -1).astype(np.float64)


def nearest(table: DataFrame, queries: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = NEAREST) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest rows of every query row.

    ``queries`` tells the query rows by the id, named ``id``; by default every ``EVERY``-th id.
    """
    asked = F.col("id") % EVERY == 0 if queries is None else queries
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")) \
        .filter(F.col("id").isNotNull() & usable(F.col("vector"))).distinct()
    # The rank limit cuts every partition before the shuffle, however many rows share a vector.
    few = rows.withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("id"))) \
        .filter(F.col("place") <= k + 1)
    nodes = stored(few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(
        F.monotonically_increasing_id().alias("node"), F.size("vector").alias("dims"), F.col("ids")[0].alias("first"), "ids", "vector"),
        "neighbours")
    asking_rows = stored(rows.filter(asked).join(nodes.select("node", "vector"), "vector").select("id", "node"),
                         "neighbours-queries")
    asking = nodes.join(asking_rows.select("node").distinct(), "node", "left_semi")
    shapes = nodes.groupBy("dims").agg(F.count("*").alias("n"), F.max(length("vector")).alias("largest")).collect()
    if not shapes:
        return hits_of(asking_rows, nodes, None, id_col, k)
    models = {r.dims: learn(sample(nodes, r.dims, r.n), r.largest, k) for r in shapes}
    total, n_asking = sum(r.n for r in shapes), asking.count()
    found = stored(reduced(search(nodes, asking, models, total, n_asking, k + 1, False), k + 1), "neighbours-found")
    # Queries that retrieved fewer nodes than there are to retrieve meet all of them.
    sizes = F.create_map(*[F.lit(x) for r in shapes for x in (r.dims, min(r.n, k + 1))])
    short = asking.join(found.groupBy(F.col("q").alias("node")).agg(F.count("*").alias("n")), "node", "left") \
        .filter(F.coalesce("n", F.lit(0)) < sizes[F.col("dims")]).drop("n", "ids")
    again = stored(short, "neighbours-short")
    n_again = again.count()
    if n_again:
        more = reduced(search(nodes, again, models, total, n_again, k + 1, True), k + 1)
        found = stored(found.join(again.select(F.col("node").alias("q")), "q", "left_anti").unionByName(more),
                       "neighbours-found")
    return hits_of(asking_rows, nodes, found, id_col, k)


def length(vector: str) -> Column:
    """Euclidean length, without squares that overflow."""
    return F.aggregate(vector, F.lit(0.0), lambda s, c: F.hypot(s, c.cast("double")))


def sample(nodes: DataFrame, dims: int, n: int) -> np.ndarray:
    """About ``SAMPLE`` vectors of one length, by a hash of the node; all if they are as few."""
    mine = nodes.filter(F.col("dims") == dims)
    if n > SAMPLE:
        mine = mine.filter(F.xxhash64("node", F.lit(2)) < F.lit(SAMPLE * 2**64 // n - 2**63))
    rows = mine.select("node", "vector").orderBy("node").limit(2 * SAMPLE).toArrow()
    return rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False) \
        .reshape(rows.num_rows, -1).astype(np.float64)


def reduced(found: DataFrame, most: int) -> DataFrame:
    """The ``most`` highest of every query. Of equal scores the nodes with the smallest ids hold the smallest ids."""
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "first", "node")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).drop("place")


def hits_of(asking_rows: DataFrame, nodes: DataFrame, found: DataFrame | None, id_col: str, k: int) -> DataFrame:
    """Nodes back to rows: ranks per query id, its own id left out."""
    if found is None:
        found = asking_rows.select(F.col("node").alias("q"), "node", F.lit(0.0).alias("score")).limit(0)
    each = found.join(nodes.select("node", "ids"), "node").select(
        "q", F.explode("ids").alias("id"), "score")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "id")
    best = each.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1) \
        .groupBy("q").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("best"))
    hits = stored(best, "neighbours-best")
    return asking_rows.select(F.col("id").alias("query_id"), F.col("node").alias("q")).join(hits, "q").select(
        "query_id", F.posexplode(F.slice(
            F.filter("best", lambda b: b["id"] != F.col("query_id")), 1, k)).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias(id_col), F.col("hit.score").alias("score"))
