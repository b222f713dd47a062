"""Readers, generators and table-level reports."""

from tallyfield.sources.delimited import read_delimited, read_delimited_inferred, write_delimited
from tallyfield.sources.generators import local_rows, uniform_values, with_uniform
from tallyfield.sources.scratch import scratch_dir
from tallyfield.sources.tables import head_rows, load_table, partition_sizes, row_counts, spread
from tallyfield.sources.text import read_lines, write_lines

__all__ = [
    "head_rows", "load_table", "local_rows", "partition_sizes", "read_delimited",
    "read_delimited_inferred", "read_lines", "row_counts", "scratch_dir", "spread",
    "uniform_values", "with_uniform", "write_delimited", "write_lines",
]
