"""Fixed values that results depend on: category orders, score tables, bin edges and labels."""

from __future__ import annotations

from tallyfield.functions.bins import Bins

# Quality order of a cut grade, worst first. Anything else ranks with the best.
CUT_ORDER = ("Fair", "Good", "Very Good", "Premium", "Ideal")

# Grade points per letter. Any other letter has no points.
GRADE_POINTS = {"A": 4, "B": 3, "C": 2, "D": 1, "F": 0}

# Carat bins. The upper edge belongs to the bin although the labels read otherwise;
# sizes outside the edges fall into the first and last bin.
CARAT_BINS = Bins(
    edges=(0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0),
    labels=("[0,1)", "[1,2)", "[2,3)", "[3,4)", "[4,5)", "[5,6]"),
    closed="right", open_low=True, open_high=True,
)

# Grade point average bins. The last bin holds both of its edges; values outside
# the edges have no bin.
GPA_BINS = Bins(
    edges=(0.0, 1.0, 2.0, 3.0, 4.0),
    labels=("[0,1)", "[1,2)", "[2,3)", "[3,4]"),
    closed="left", close_last=True,
)
