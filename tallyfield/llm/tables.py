"""Helpers shared by the operators: tables on shared storage, column names, Arrow row slices."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyfield.sources.scratch import scratch_dir

# Characters of text that a Python worker turns into words at once.
SLICE_CHARS = 2_000_000


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lineage ends here.

    Unlike a cached or locally checkpointed table, the files outlive a lost executor.
    """
    folder = scratch_dir(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores before it until no taken name equals it in any letter case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def crc_bucket(column: str, buckets: int) -> Column:
    """crc32 of the column's text modulo ``buckets``; NULL counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % buckets


_HELD: dict[object, object] = {}


def held(key: object, make: Callable[[], object]) -> object:
    """What a Python worker keeps between tasks: one thing at a time, so that its memory is bounded.

    Asking for another thing lets go of the one before.
    """
    if key not in _HELD:
        _HELD.clear()
        trim()
        _HELD[key] = make()
    return _HELD[key]


def trim() -> None:
    """Give freed memory back to the system; an idle worker would keep it beside those of the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def thrifty(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` over a partition's batches, with memory given back at the end."""
    def all_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return all_of


def add_columns(
    df: DataFrame, needs: list[str], added: str, make: Callable[[], Callable[..., list]],
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with the columns of the DDL ``added``, computed from the columns ``needs``.

    ``keep`` names the columns of ``df`` that come back from Python, all by default.

    ``make`` runs once per task and gives a function from a slice of the needed columns (lists of
    Python values) to the new columns (lists or Arrow arrays, one value per row). A slice holds
    about ``SLICE_CHARS`` characters of its last needed column, or one longer row.
    """
    extra = T.StructType.fromDDL(added)
    kept = df.columns if keep is None else keep
    full = T.StructType([*(df.schema[c] for c in kept), *extra])
    arrow_extra = to_arrow_schema(extra)
    names = list(needs)
    order = {name: i for i, name in enumerate(df.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None, lambda: None)
        work = make()
        for batch in batches:
            for part in row_slices(batch, order[names[-1]]):
                columns = work(*(part.column(order[n]).to_pylist() for n in names))
                arrays = [part.column(order[c]) for c in kept] + [
                    c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                    for c, f in zip(columns, arrow_extra, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=full.names)

    return df.mapInArrow(thrifty(run), full)


def row_slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``SLICE_CHARS`` bytes of the text column, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > SLICE_CHARS:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start, len(sizes) - start)


def gathered(batches: Iterable[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Batches joined and cut to about ``size`` bytes of the text column: the more texts stand together, the
    more of their words are the same."""
    waiting, held_bytes = [], 0
    for batch in batches:
        for part in row_slices(batch, column):
            waiting.append(part)
            held_bytes += part.column(column).nbytes
            if held_bytes >= size:
                yield pa.concat_batches(waiting)
                waiting, held_bytes = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def strings(array: pa.Array) -> list[str]:
    """A text column without NULLs as a list, faster than value by value."""
    return array.to_numpy(zero_copy_only=False).tolist()
