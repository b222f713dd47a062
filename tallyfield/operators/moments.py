"""Sums, means and squared deviations that are right for every double and for every partitioning.

A value is scaled by a power of two, so that the largest of the column stands just below 2^24, and
cut into whole numbers of 24 bits, as many as it takes to reach the last bit of the smallest one. Their
sums are whole numbers as well, so no order of addition changes them. The driver gets these few sums
and finishes with whole numbers of any size: a total or mean is the double
nearest to the true one. Squares are taken around a mean that is known first, so nothing cancels; each is
rounded once and added to 2^-96 of the largest.
NaN and infinities are counted apart. Columns of up to 2^39 rows fit the sums.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24
# Pieces of squares, which are rounded anyway.
SQUARE_PIECES = 4
MANTISSA = 53


@dataclass(frozen=True)
class Total:
    """The exact sum of the finite values, and how many values of each kind there are."""

    exact: Fraction
    n: int
    nan: int = 0
    positive: int = 0
    negative: int = 0

    @property
    def value(self) -> float | None:
        """The sum as a double; NULL of no values, NaN or infinite as the values are."""
        if not self.n:
            return None
        if self.nan or self.positive and self.negative:
            return math.nan
        if self.positive or self.negative:
            return math.inf if self.positive else -math.inf
        return nearest(self.exact)

    @property
    def mean(self) -> float | None:
        value = self.value
        return value if value is None or not math.isfinite(value) and self.nan + self.positive + self.negative \
            else nearest(self.exact / self.n)


def nearest(value: Fraction) -> float:
    try:
        return float(value)
    except OverflowError:
        return math.inf if value > 0 else -math.inf


def finite(x: Column) -> Column:
    """``x`` where it is finite, else NULL."""
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), x)


def size_range(x: Column, name: str) -> list[Column]:
    """The largest and the smallest size of the finite values that are not zero."""
    size = F.abs(finite(x))
    return [F.max(size).alias(f"{name} most"), F.min(F.when(size > 0, size)).alias(f"{name} least")]


def exact_totals(df: DataFrame, columns: Mapping[str, Column], ranges: Mapping[str, tuple[float, float | None]] | None = None) -> dict[str, Total]:
    """The exact sum of each column. ``ranges`` has the largest and smallest sizes of the values, which otherwise
    take a pass of their own; without a smallest one sums are exact to 2^-96 of the largest."""
    if ranges is None:
        found = df.agg(*[c for name, x in columns.items() for c in size_range(x, name)]).first()
        ranges = {name: (found[f"{name} most"] or 0.0, found[f"{name} least"] or 1.0) for name in columns}
    exponent = {name: math.frexp(most)[1] for name, (most, _) in ranges.items()}
    pieces = {name: SQUARE_PIECES if least is None else max(1, -(-(exponent[name] - math.frexp(least)[1] + MANTISSA) // BITS))
              for name, (_, least) in ranges.items()}
    sums = []
    for name, x in columns.items():
        sums += [F.count(x).alias(f"{name} n"), F.count_if(F.isnan(x)).alias(f"{name} nan"),
                 F.count_if(x == F.lit(math.inf)).alias(f"{name} positive"),
                 F.count_if(x == F.lit(-math.inf)).alias(f"{name} negative")]
        for piece in range(pieces[name]):
            sums.append(F.sum(bits(finite(x), BITS * (piece + 1) - exponent[name], not piece)).alias(f"{name} {piece}"))
    row = df.agg(*sums).first()
    out = {}
    for name in columns:
        count = pieces[name]
        whole = sum((row[f"{name} {piece}"] or 0) << BITS * (count - 1 - piece) for piece in range(count))
        exact = Fraction(whole) * Fraction(2) ** (exponent[name] - BITS * count)
        out[name] = Total(exact, *(row[f"{name} {kind}"] for kind in ("n", "nan", "positive", "negative")))
    return out


def bits(x: Column, power: int, first: bool) -> Column:
    """The whole part of ``x`` times a power of two, without what the piece before holds of it."""
    here, before = scaled(x, power), scaled(x, power - BITS)
    if first:
        return F.rint(here).cast("bigint")
    # From 2^53 on a double is whole: nothing is left of it.
    rest = F.rint(here) - F.rint(before) * F.lit(2.0 ** BITS)
    return F.when(F.abs(before) < F.lit(2.0 ** MANTISSA), rest).otherwise(F.when(x.isNotNull(), 0.0)).cast("bigint")


def scaled(x: Column, power: int) -> Column:
    """``x`` times a power of two, in steps that a double can hold."""
    while abs(power) > 1000:
        step = math.copysign(1000, power)
        x, power = x * F.lit(2.0 ** step), int(power - step)
    return x * F.lit(2.0 ** power)


def squares_around(df: DataFrame, columns: Mapping[str, tuple[Column, float]], most: Mapping[str, float]) -> dict[str, Fraction | None]:
    """The sum of squared distances of each column's finite values from a given point; NULL if one is infinite.

    ``most`` bounds the distances.
    """
    def squared(x: Column, point: float) -> Column:
        away = finite(x) - F.lit(point)
        return away * away

    top = {name: m * m * (1 + 1e-9) for name, m in most.items()}
    if not all(map(math.isfinite, top.values())):
        return {name: None for name in columns}
    totals = exact_totals(df, {name: squared(x, point) for name, (x, point) in columns.items()},
                          {name: (top[name], None) for name in columns})
    return {name: total.exact for name, total in totals.items()}
