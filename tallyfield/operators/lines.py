"""Typed rows from delimited text lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def _typed(i: int, kind: str | DataType, fail: bool) -> Column:
    part = F.get("parts", i)
    value = part.try_cast(kind)
    if not fail:
        return value
    message = F.concat(F.lit(f"field {i + 1} does not parse: "), F.coalesce(part, F.lit("missing")))
    return F.when(value.isNull(), F.raise_error(message).cast(kind)).otherwise(value)


def parse_numbers(
    lines: DataFrame, names: Sequence[str], sep: str = " ", line: str = "line", fail: bool = False,
) -> DataFrame:
    """One DOUBLE column per leading token; NULL where a token is missing or no number.

    With ``fail`` a token that is no number is an error, as is a missing one.
    """
    parts = lines.select(F.split(F.col(line), f"\\Q{sep}\\E").alias("parts"))
    return parts.select(*[
        _typed(i, "double", fail).alias(name) for i, name in enumerate(names)
    ])


def parse_records(
    lines: DataFrame, schema: str, sep: str = "\t", header: str | None = None, line: str = "line",
    fail: bool = False,
) -> DataFrame:
    """Columns typed by a DDL schema, by position.

    Only lines equal to ``header`` are dropped: a data line that merely holds one of the column
    names stays. A field that does not parse is NULL, or an error with ``fail``.
    """
    if header is not None:
        lines = lines.filter(F.col(line) != header)
    parts = lines.select(F.split(F.col(line), f"\\Q{sep}\\E").alias("parts"))
    return parts.select(*[
        _typed(i, field.dataType, fail).alias(field.name)
        for i, field in enumerate(StructType.fromDDL(schema))
    ])
