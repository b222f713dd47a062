"""Category to number mappings as CASE expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_category(column: Column | str, mapping: Mapping[str, int], default: int | None = None) -> Column:
    """INT score of a category; ``default`` (NULL unless given) for the others and for NULL."""
    column = F.col(column) if isinstance(column, str) else column
    score = F
    for value, number in mapping.items():
        score = score.when(column == F.lit(value), F.lit(number).cast("int"))
    return score.otherwise(F.lit(default).cast("int"))


def ordinal_rank(column: Column | str, ordered: Sequence[str], default: int | None = None) -> Column:
    """1-based position of a category in ``ordered``; use it as a sort key."""
    return map_category(column, {value: i for i, value in enumerate(ordered, start=1)}, default)


def mapping_sql(name: str, mapping: Mapping[str, int], default: int | None = None) -> str:
    """The same mapping as a SQL CASE over ``name``."""
    arms = " ".join(f"WHEN {name} = '{value}' THEN {number}" for value, number in mapping.items())
    return f"CASE {arms} ELSE {'NULL' if default is None else default} END"
