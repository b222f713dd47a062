"""Tallyfield: log, text, relational, streaming and classifier analytics on Spark DataFrames."""

from tallyfield.session import build_session

__all__ = ["build_session"]
