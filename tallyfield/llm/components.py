"""Connected components: inside one task over arrays, and over a table of edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.tables import stored, thrifty


def local_roots(roots: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``roots`` (position -> smallest known position of its component), changed in place, after adding links."""
    while True:
        a, b = roots[left], roots[right]
        apart = a != b
        if not apart.any():
            return roots
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(roots, np.maximum(a, b), np.minimum(a, b))
        while True:
            jumped = roots[roots]
            if np.array_equal(jumped, roots):
                break
            roots = jumped


# Edges that a task gathers before it reduces them to a spanning forest.
GATHERED = 1_000_000


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of one partition's edges: at most one edge per node, same components."""
    left, right, waiting = [], [], 0
    for batch in batches:
        left.append(batch.column(0).to_numpy())
        right.append(batch.column(1).to_numpy())
        waiting += batch.num_rows
        if waiting > GATHERED:
            a, b = spanning(np.concatenate(left), np.concatenate(right))
            left, right, waiting = [a], [b], 0
    if left:
        a, b = spanning(np.concatenate(left), np.concatenate(right))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def spanning(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of every node but those smallest ones."""
    nodes, index = np.unique(np.concatenate([left, right]), return_inverse=True)
    roots = local_roots(np.arange(len(nodes)), index[:len(left)], index[len(left):])
    child = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[child], nodes[roots[child]]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has an edge; the root is the smallest node it can reach.

    Alternates two steps until no edge changes: every node links its larger neighbours to its
    smallest one, then its smaller neighbours and itself. A node with very many edges is met as one
    pre-aggregated minimum and in joins that adaptive execution can split. Each partition of the
    edges is reduced to a spanning forest first. Each round is written to shared storage, so a lost
    executor costs no earlier round.
    """
    links = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).mapInArrow(thrifty(forest), "a long, b long").select(
        F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "components")
    mark = _mark(links)
    while True:
        both = links.unionAll(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("low")).select(
            "v", F.least("v", "low").alias("low"))
        # Larger neighbours of v go to the smallest neighbour of v.
        large = links.join(least.select(F.col("v").alias("u"), "low"), "u").select(
            "v", F.col("low").alias("u")).distinct()
        low = large.groupBy("v").agg(F.min("u").alias("low"))
        small = large.join(low, "v").filter("u <> low").select(F.col("u").alias("v"), F.col("low").alias("u")) \
            .unionAll(low.select("v", F.col("low").alias("u"))).distinct()
        links = stored(small, "components")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    return links.select(F.col("v").alias("node"), F.col("u").alias("root")).unionAll(
        links.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def _mark(links: DataFrame) -> tuple:
    """Number and order-free checksum of the edges."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u"))).first())
