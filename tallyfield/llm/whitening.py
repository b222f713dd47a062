"""Whitening of vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Every component c, as a double, becomes the integer x = floor(256 c), held to the range of 64 bits.
The model is fitted on each distinct integer vector once: exact sums per dimension first, then every
partition adds up the products of its centred vectors, and Spark adds the partitions' triangles. The
scatter G (one number per pair of dimensions, whatever the rows) is factored on the driver,
G = L L' with the largest remaining diagonal first, which stops at the rank. Rotations of pairs of
columns make the columns of L orthogonal: their squared lengths are the eigenvalues of G, and scaled
to length one they are the components. One more pass over the fit list measures how far the
whitened vectors' covariance is from the identity.

Vectors of different lengths are fitted apart, each length with a model of its own. The driver holds
one model per length, of the size of a square of that length.

Cases. Vectors that are NULL, empty, or hold NULL or non-finite components are dropped. Repeated
rows come back as often as they occur and count once in the fit; NULL ids are kept. Components
without variance have no whitened value and are left out, so vectors that are all equal, a single
one, or fewer than five dimensions give fewer components or no rows. Equal eigenvalues are numbered
in the order in which the rotations leave them. Deviations are exact; those of 10^38 and more are
NULL. An empty table gives no rows. Only the two named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyfield.llm.tables import stored

STEPS = 256
COMPONENTS = 4
# What is left of a diagonal entry below this share of it, times the dimensions, counts as rounding.
RANK_SHARE = 1e-13
# Two columns are orthogonal when their cosine is below this.
ORTHOGONAL = 1e-15
SWEEPS = 60
# Rows that are centred and multiplied at once.
CHUNK = 8192


@dataclass(frozen=True)
class Model:
    """Moments and components of the vectors of one length. Columns of ``axes`` are components."""

    n: int
    sums: tuple[int, ...]
    largest: int  # no |n x - S| of the fit list is above it
    axes: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S of every row; Python integers where 64 bits could overflow."""
        whole = np.int64 if self.largest < 1 << 62 else object
        return self.n * x.astype(whole) - np.array(self.sums, whole)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.n).astype(float) @ self.axes / np.sqrt(self.eigenvalues)


def finite_only(vector: Column) -> Column:
    """Not NULL, not empty, no NULL or non-finite component."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def integers(vector: Column) -> Column:
    """floor(256 c) of every component as a long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * STEPS).cast("long"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of lists of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def by_length(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions in the batch, matrix) of each length of vectors, in pieces of ``CHUNK`` rows."""
    for batch in batches:
        lengths = pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
        for length in np.unique(lengths):
            found = np.flatnonzero(lengths == length)
            for start in range(0, len(found), CHUNK):
                rows = found[start:start + CHUNK]
                yield batch, rows, matrix(batch.column(column).take(pa.array(rows)))


def moments(distinct: DataFrame) -> dict[int, tuple[int, list[int], int]]:
    """length -> (n, sums, bound of |n x - S|), exact: 64-bit numbers are added in two halves."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for _, rows, x in by_length(batches):
            new = [np.full(x.shape[1], len(rows)), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0),
                   x.min(axis=0), x.max(axis=0)]
            old = held.get(x.shape[1])
            held[x.shape[1]] = new if old is None else [
                old[0] + new[0], old[1] + new[1], old[2] + new[2], np.minimum(old[3], new[3]), np.maximum(old[4], new[4])]
        for length, arrays in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(length, length)), pa.array(np.arange(length)), *map(pa.array, arrays)],
                names=["dims", "i", "n", "high", "low", "least", "most"])

    whole = "decimal(38,0)"
    rows = distinct.mapInArrow(parts, "dims long, i long, n long, high long, low long, least long, most long") \
        .groupBy("dims", "i").agg(
            F.sum("n").alias("n"), F.sum(F.col("high").cast(whole)).alias("high"),
            F.sum(F.col("low").cast(whole)).alias("low"), F.min("least").alias("least"), F.max("most").alias("most")) \
        .orderBy("dims", "i").collect()
    found: dict[int, tuple[int, list[int], int]] = {}
    for r in rows:
        n, sums, bound = found.get(r.dims, (r.n, [], 0))
        total = (int(r.high) << 32) + int(r.low)
        span = max(abs(n * r.least - total), abs(n * r.most - total), abs(n * r.least), abs(n * r.most), abs(total))
        found[r.dims] = (n, [*sums, total], max(bound, span))
    return found


def triangles(distinct: DataFrame, centre) -> dict[int, np.ndarray]:
    """length -> sum over the fit list of v v', for the vectors v that ``centre`` makes of a matrix."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for _, _, x in by_length(batches):
            v = centre(x)
            held[x.shape[1]] = held.get(x.shape[1], 0.0) + v.T @ v
        for length, g in held.items():
            i, j = np.triu_indices(len(g))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), length)), pa.array(i), pa.array(j), pa.array(g[i, j])],
                names=["dims", "i", "j", "g"])

    rows = distinct.mapInArrow(parts, "dims long, i long, j long, g double") \
        .groupBy("dims", "i", "j").agg(F.sum("g").alias("g")).toArrow()
    dims, i, j, g = (c.to_numpy() for c in rows.columns)
    out = {}
    for length in np.unique(dims):
        mine = dims == length
        size = int(j[mine].max()) + 1
        full = np.zeros((size, size))
        full[i[mine], j[mine]] = full[j[mine], i[mine]] = g[mine]
        out[int(length)] = full
    return out


def pivoted_cholesky(g: np.ndarray) -> np.ndarray:
    """L with g = L L', a column per step, the largest remaining diagonal first, as many as the rank."""
    rest = np.diag(g).copy()
    rounding = RANK_SHARE * len(g) * rest
    factor = np.zeros(g.shape)
    for k in range(len(g)):
        rest[rest <= rounding] = 0.0
        p = int(rest.argmax())
        if rest[p] <= 0:
            return factor[:, :k]
        column = (g[:, p] - factor[:, :k] @ factor[p, :k]) / np.sqrt(rest[p])
        factor[:, k] = column
        rest -= column * column
        rest[p] = 0.0
    return factor


def jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor`` rotated until every two are orthogonal, longest first.

    A sweep meets every pair once, in rounds of disjoint pairs that turn at the same time.
    """
    a = np.array(factor, float)
    count = a.shape[1]
    if count > 1:
        seats = np.arange(count + count % 2)
        for _ in range(SWEEPS):
            turned = False
            for _ in range(len(seats) - 1):
                p, q = seats[:len(seats) // 2], seats[:len(seats) // 2 - 1:-1]
                real = (p < count) & (q < count)
                turned |= rotate(a, p[real], q[real])
                seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
            if not turned:
                break
    return a[:, np.argsort(-(a * a).sum(axis=0), kind="stable")]


def rotate(a: np.ndarray, p: np.ndarray, q: np.ndarray) -> bool:
    """Turn the column pairs (p, q) so that each becomes orthogonal; whether one had to."""
    left, right = a[:, p], a[:, q]
    alpha, beta, gamma = (left * left).sum(0), (right * right).sum(0), (left * right).sum(0)
    apart = np.abs(gamma) > ORTHOGONAL * np.sqrt(alpha * beta)
    if not apart.any():
        return False
    p, q, left, right = p[apart], q[apart], left[:, apart], right[:, apart]
    zeta = (beta[apart] - alpha[apart]) / (2 * gamma[apart])
    tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
    cosine = 1 / np.hypot(1.0, tangent)
    sine = cosine * tangent
    a[:, p], a[:, q] = cosine * left - sine * right, sine * left + cosine * right
    return True


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """length -> model over the rows of ``distinct``, a table of one column of integer vectors."""
    models = {}
    first = {
        length: Model(n, tuple(sums), bound, np.zeros((length, 0)), np.zeros(0), 0.0)
        for length, (n, sums, bound) in moments(distinct).items()}
    scatter = triangles(distinct, lambda x: (first[x.shape[1]].deviations(x) / first[x.shape[1]].n).astype(float))
    for length, start in first.items():
        turned = jacobi(pivoted_cholesky(scatter[length]))[:, :components]
        lengths = np.sqrt((turned * turned).sum(axis=0))
        models[length] = Model(
            start.n, start.sums, start.largest, turned / lengths, lengths ** 2 / start.n,
            float(np.trace(scatter[length])) / start.n)
    errors = triangles(distinct, lambda x: with_ones(models[x.shape[1]].whitened(models[x.shape[1]].deviations(x))))
    return {length: Model(**{**vars(m), "identity_error": identity_error(errors[length], m.n)})
            for length, m in models.items()}


def with_ones(values: np.ndarray) -> np.ndarray:
    return np.column_stack([values, np.ones(len(values))])


def identity_error(products: np.ndarray, n: int) -> float:
    """Largest entry of |covariance - identity|, from the products of (values, 1)."""
    mean = products[:-1, -1] / n
    covariance = products[:-1, :-1] / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(len(mean))).max(initial=0.0))


def exact_squares(deviations: np.ndarray, bound: int) -> list[Decimal | None]:
    """Sums of squares of every row as whole numbers."""
    if deviations.dtype == np.int64 and bound * bound * deviations.shape[1] < 1 << 63:
        sums = (deviations * deviations).sum(axis=1).tolist()
    else:
        sums = (deviations.astype(object) ** 2).sum(axis=1).tolist()
    return [Decimal(s) if s < 10**38 else None for s in sums]


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    ``deviation`` is the sum over the dimensions of (n x - S)^2 as DECIMAL(38, 0).
    """
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")) \
        .filter(finite_only(F.col("vector"))).select("id", integers(F.col("vector")).alias("x"))
    # Grouping combines equal vectors before the shuffle, however many copies one has.
    distinct = stored(rows.select("x").distinct(), "whitening")
    models = fit(distinct, components)
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), *T.StructType.fromDDL(
        "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")])
    arrow = to_arrow_schema(schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found, x in by_length(batches, 1):
            model = models[x.shape[1]]
            deviations = model.deviations(x)
            values = model.whitened(deviations)
            count, each = len(found), values.shape[1]
            if not each:
                continue
            squares = exact_squares(deviations, model.largest)
            columns = [
                batch.column(0).take(pa.array(np.repeat(found, each))), np.tile(np.arange(1, each + 1), count),
                np.full(count * each, model.n), [s for s in squares for _ in range(each)], values.ravel(),
                np.tile(model.eigenvalues / model.trace, count), np.full(count * each, model.identity_error)]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                 for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return rows.mapInArrow(apply, schema)
