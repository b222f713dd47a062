"""Rounding and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A ratio that lies on a rounding tie moves off it by an ulp when its sums are added in another
# order. The nudge is far above that error and far below any digit that is reported, so equal
# inputs round equally however they are partitioned.
NUDGE = 1e-9


def round_stable(column: Column, digits: int) -> Column:
    """Round half away from zero, with the same result for every order of summation."""
    return F.round(column + F.signum(column) * F.lit(NUDGE), digits)


def exact_sum(column: Column | str, scale: int = 4) -> Column:
    """Sum of doubles after rounding each to ``scale`` decimals: the same in every order of addition.

    The sum is taken in DECIMAL; a value of 10^(28 - scale) or more is an error, not a wrong sum.
    """
    value = F.col(column) if isinstance(column, str) else column
    return F.sum(value.cast(f"decimal(28,{scale})")).cast("double")


def round_half_even(column: Column, digits: int) -> Column:
    """Round ties to the even digit, as Python's ``round`` does for ties a double can hold."""
    return F.bround(column, digits)


def ratio(top: Column, bottom: Column, digits: int | None = None) -> Column:
    """``top / bottom``; NULL where the denominator is zero."""
    value = F.try_divide(top.cast("double"), bottom.cast("double"))
    return value if digits is None else round_stable(value, digits)
