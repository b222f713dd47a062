"""Named SQL functions for ``spark.sql``, ``expr`` and ``call_function``.

The functions have SQL bodies, so the analyser replaces each call by its CASE expression:
filters still push down, code generation still applies and no Python worker starts.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyfield.functions import presets
from tallyfield.functions.categories import mapping_sql


def register_sql_function(spark: SparkSession, name: str, argument: str, returns: str, body: str) -> None:
    """Register ``name(argument) RETURNS returns`` for this session. ``argument`` is 'x TYPE'."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({argument}) RETURNS {returns} RETURN {body}")


def register_functions(spark: SparkSession) -> list[str]:
    """Register the built-in category and bin functions; returns their names."""
    ranks = {value: i for i, value in enumerate(presets.CUT_ORDER, start=1)}
    bodies = {
        "rank_cut": ("x STRING", "INT", mapping_sql("x", ranks, default=len(ranks))),
        "carat_bin": ("x DOUBLE", "STRING", presets.CARAT_BINS.sql("x")),
        "convert_grade": ("x STRING", "INT", mapping_sql("x", presets.GRADE_POINTS)),
        "get_gpa_range": ("x DOUBLE", "STRING", presets.GPA_BINS.sql("x")),
    }
    for name, (argument, returns, body) in bodies.items():
        register_sql_function(spark, name, argument, returns, body)
    return list(bodies)
