"""Dense and sparse array forms, and in-row majority votes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sparse_form(dense: Column) -> Column:
    """STRUCT(size, indices, values) of the non-zero slots of an ARRAY<DOUBLE>."""
    slots = F.transform(dense, lambda value, i: F.struct(i.alias("slot"), value.alias("value")))
    kept = F.filter(slots, lambda entry: entry["value"] != 0)
    return F.struct(
        F.size(dense).alias("size"),
        F.transform(kept, lambda entry: entry["slot"]).alias("indices"),
        F.transform(kept, lambda entry: entry["value"]).alias("values"),
    )


def dense_form(size: Column, indices: Column, values: Column) -> Column:
    """ARRAY<DOUBLE> of ``size`` slots with ``values`` at ``indices`` and 0 elsewhere."""
    slots = F.slice(F.sequence(F.lit(0), size), 1, size)
    stored = F.map_from_arrays(indices, values)
    return F.transform(slots, lambda i: F.coalesce(F.try_element_at(stored, i), F.lit(0.0)))


def majority(votes: Sequence[Column | str]) -> Column:
    """Most frequent of several columns of one row; a tie goes to the smallest value.

    Nothing leaves the row, so no shuffle is needed.
    """
    cast = F.array(*[F.col(v) if isinstance(v, str) else v for v in votes]).cast("array<double>")
    tally = F.transform(
        F.array_distinct(cast),
        lambda value: F.struct(
            F.size(F.filter(cast, lambda other: other == value)).alias("n"),
            (-value).alias("negated"),
        ),
    )
    return -F.array_max(tally)["negated"]
