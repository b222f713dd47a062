"""Column builders. All of them expand to built-in Catalyst expressions."""

from tallyfield.functions.bins import Bins, bin_label
from tallyfield.functions.categories import map_category, ordinal_rank
from tallyfield.functions.registry import register_functions
from tallyfield.functions.rounding import exact_sum, ratio, round_half_even, round_stable
from tallyfield.functions.uniform import keyed_uniform
from tallyfield.functions.vectors import dense_form, majority, sparse_form

__all__ = [
    "Bins", "bin_label", "dense_form", "exact_sum", "majority", "map_category", "ordinal_rank", "ratio",
    "keyed_uniform", "register_functions", "round_half_even", "round_stable", "sparse_form",
]
