"""Interval labels for numeric columns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bins:
    """Adjacent intervals over a numeric column.

    ``closed`` names the edge that belongs to an interval. ``close_last`` makes the last interval
    of a left-closed set hold its upper edge too. ``open_low`` and ``open_high`` let the first and
    last interval take every value beyond the outer edges; otherwise such values have no label.
    """

    edges: tuple[float, ...]
    labels: tuple[str, ...] = ()
    closed: str = "right"
    close_last: bool = False
    open_low: bool = False
    open_high: bool = False

    def __post_init__(self):
        if len(self.edges) < 2 or any(a >= b for a, b in zip(self.edges, self.edges[1:])):
            raise ValueError("edges must be at least two increasing numbers")
        if self.closed not in ("left", "right"):
            raise ValueError("closed must be 'left' or 'right'")
        if self.labels and len(self.labels) != len(self.edges) - 1:
            raise ValueError("one label per interval is needed")

    def names(self) -> tuple[str, ...]:
        if self.labels:
            return self.labels
        spans = zip(self.edges, self.edges[1:])
        if self.closed == "right":
            return tuple(f"({a:g},{b:g}]" for a, b in spans)
        names = [f"[{a:g},{b:g})" for a, b in spans]
        if self.close_last:
            names[-1] = names[-1][:-1] + "]"
        return tuple(names)

    def tests(self) -> list[tuple[list[tuple[str, float]], str]]:
        """Per interval: comparisons that must all hold, and its label."""
        last = len(self.edges) - 2
        above, below = (">", "<=") if self.closed == "right" else (">=", "<")
        rows = []
        for i, label in enumerate(self.names()):
            tests = []
            if not (i == 0 and self.open_low):
                tests.append((above, self.edges[i]))
            if not (i == last and self.open_high):
                upper = "<=" if i == last and self.close_last else below
                tests.append((upper, self.edges[i + 1]))
            rows.append((tests, label))
        return rows

    def sql(self, name: str) -> str:
        """The labelling as a SQL CASE over ``name``."""
        arms = []
        for tests, label in self.tests():
            condition = " AND ".join(f"{name} {op} {edge!r}D" for op, edge in tests)
            arms.append(f"WHEN {condition or name + ' IS NOT NULL'} THEN '{label}'")
        return f"CASE {' '.join(arms)} END"


_COMPARE = {
    ">": lambda column, edge: column > edge,
    ">=": lambda column, edge: column >= edge,
    "<": lambda column, edge: column < edge,
    "<=": lambda column, edge: column <= edge,
}


def bin_label(column: Column | str, bins: Bins) -> Column:
    """Label of the interval that holds the value; NULL where there is none."""
    column = F.col(column) if isinstance(column, str) else column
    label = F
    for tests, name in bins.tests():
        conditions = [_COMPARE[op](column, F.lit(float(edge))) for op, edge in tests]
        held = reduce(lambda a, b: a & b, conditions) if conditions else column.isNotNull()
        label = label.when(held, F.lit(name))
    return label
