"""Sums and spreads against calculation with big numbers."""

import math
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfield.operators import aggregates, moments
from tallyfield.sources import local_rows


def plain(values):
    """(total, mean, stdev) of finite doubles, rounded once."""
    exact = [Fraction(v) for v in values]
    mean = sum(exact) / len(exact)
    spread = math.sqrt(sum((v - mean) ** 2 for v in exact) / len(exact)) if max(map(abs, values)) < 1e150 else None
    return float(sum(exact)), float(mean), spread


def table(spark, values, parts=3):
    return local_rows(spark, [[v] for v in values], "x DOUBLE").repartition(parts)


@pytest.mark.parametrize("values", [
    [1e9, 1e9 + 1, 1e9 + 2], [1e-7, 2e-7, 3e-7], [1e12, 2e12], [1e12, -1e12, 1e-7], [0.1] * 10, [0.0, -0.0], [5e-324, 1e-310],
    [1.7e308, -1.7e308, 3.0], [1e300, 2e300], [-3.5], [1 / 3, 1e16, -1e16, 2 / 3]])
def test_equals_big_numbers(spark, values):
    for parts in (1, 4):
        row = aggregates.numeric_summary(table(spark, values, parts), "x").first()
        total, mean, stdev = plain(values)
        assert (row.total, row.mean) == (total, mean)
        assert stdev is None or row.stdev == pytest.approx(stdev, rel=1e-12, abs=1e-300)
        assert (row.minimum, row.maximum) == (min(values), max(values))


def test_strange_values(spark):
    nan, inf = math.nan, math.inf
    def shown(values):
        return [repr(v) for v in aggregates.numeric_summary(table(spark, values), "x").first()]
    assert shown([nan, 1.0]) == ["nan", "nan", "nan", "1.0", "nan"]
    assert shown([inf, 1.0]) == ["inf", "inf", "nan", "1.0", "inf"]
    assert shown([inf, -inf]) == ["nan", "nan", "nan", "-inf", "inf"]
    assert shown([None, None]) == ["None"] * 5
    assert shown([None, 2.0]) == ["2.0", "2.0", "0.0", "2.0", "2.0"]


@settings(deadline=None, max_examples=8)
@given(st.lists(st.floats(-1e9, 1e9).map(lambda v: math.ldexp(v, 0)), min_size=1, max_size=40))
def test_any_order_gives_one_total(spark, values):
    top = max(map(abs, values))
    found = [moments.exact_totals(table(spark, order, parts), {"x": moments.F.col("x")})["x"]
             for order, parts in ((values, 1), (values[::-1], 5))]
    assert found[0] == found[1]
    assert abs(found[0].exact - sum(map(Fraction, values))) <= len(values) * Fraction(top) / 2**96


def test_quality_does_not_depend_on_partitions(spark, sf):
    from tallyfield.sources import load_table
    items = load_table(spark, sf, "lineitem").selectExpr("l_extendedprice AS a", "l_quantity * 1500 AS p")
    found = {tuple(aggregates.fit_quality(items.repartition(n), "a", "p").first()) for n in (1, 7, 40)}
    assert len(found) == 1
    pairs = [(r.a, r.p) for r in items.collect()]
    mean = sum(Fraction(a) for a, _ in pairs) / len(pairs)
    (row,) = found
    assert row[1] == float(mean)
    assert row[2] == pytest.approx(float(sum((Fraction(a) - Fraction(p)) ** 2 for a, p in pairs)), rel=1e-15)
    assert row[3] == pytest.approx(float(sum((Fraction(a) - mean) ** 2 for a, _ in pairs)), rel=1e-14)
