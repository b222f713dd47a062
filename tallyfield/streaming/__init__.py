"""Structured Streaming sources, summaries and sinks."""

from tallyfield.streaming.sinks import run_to_memory, run_to_table, start_memory, start_table
from tallyfield.streaming.sources import borrow_schema, stream_delimited

__all__ = [
    "borrow_schema", "run_to_memory", "run_to_table", "start_memory", "start_table",
    "stream_delimited",
]
