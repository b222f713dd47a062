"""Access log reports over the events table rendered as log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.operators import logs
from tallyfield.operators.aggregates import count_by, substring_counts, top_k
from tallyfield.sources import load_table, read_lines, scratch_dir, spread, write_lines


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One access log line per event, as column ``line``."""
    kind, value = F.col("event_type"), F.col("value")
    status = (
        F.when((kind == "error") & (value >= 50), "500")
        .when(kind == "error", "404")
        .when(kind == "signup", "302")
        .when(value < 5, "304")
        .otherwise("200")
    )
    size = F.when(value < 10, "-").otherwise(F.round(value * 100).cast("bigint").cast("string"))
    events = spread(load_table(spark, sf, "events").drop("event_id"))
    return events.select(F.concat(
        F.lit("u"), F.col("user_id").cast("string"),
        F.lit(" ["), F.date_format("ts", "dd:HH:mm:ss"),
        F.lit(' "'), F.upper(kind),
        F.lit(" /k/"), F.get_json_object("props", "$.k"),
        F.lit('" '), status, F.lit(" "), size,
    ).alias("line"))


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return logs.parse_access_log(log_lines(spark, sf))


def log_scan_count(spark, sf):
    path = write_lines(log_lines(spark, sf), scratch_dir(spark, "log"))
    return read_lines(spark, path).agg(F.count("*").alias("n"))


def log_parse(spark, sf):
    return parsed(spark, sf).drop("n_tokens")


def top_by(column: str):
    def plan(spark, sf):
        return top_k(count_by(parsed(spark, sf), column), [F.col("n").desc(), column], 10)
    return plan


def count_of(column: str):
    return lambda spark, sf: count_by(parsed(spark, sf), column).orderBy(column)


def distinct_of(column: str):
    return lambda spark, sf: logs.distinct_values(parsed(spark, sf), column)


def log_avg_bytes(spark, sf):
    return logs.mean_bytes(parsed(spark, sf)).orderBy("method")


def log_status_by_method(spark, sf):
    return logs.status_sets(parsed(spark, sf)).orderBy("method")


def log_substrings(spark, sf):
    needles = {"n_click": "CLICK", "n_view": "VIEW", "n_error": "ERROR"}
    return substring_counts(log_lines(spark, sf), "line", needles)


QUERIES = {
    "log_scan_count": log_scan_count,
    "log_parse": log_parse,
    "log_top_resources": top_by("resource"),
    "log_top_origins": top_by("host"),
    "log_methods_distinct": distinct_of("method"),
    "log_status_codes": distinct_of("status"),
    "log_method_counts": count_of("method"),
    "log_status_counts": count_of("status"),
    "log_requests_by_day": count_of("day"),
    "log_avg_bytes": log_avg_bytes,
    "log_status_by_method": log_status_by_method,
    "substring_counts": log_substrings,
}

# The oracle derives every field from the event columns, without rendering or parsing a line.
_FIELDS = """
WITH log AS (
  SELECT 'u' || user_id AS host,
         '[' || strftime(ts, '%d:%H:%M:%S') AS stamp,
         strftime(ts, '%d') AS day,
         upper(event_type) AS method,
         '/k/' || (props::JSON ->> '$.k') AS resource,
         CASE WHEN event_type = 'error' AND value >= 50 THEN '500'
              WHEN event_type = 'error' THEN '404'
              WHEN event_type = 'signup' THEN '302'
              WHEN value < 5 THEN '304' ELSE '200' END AS status,
         CASE WHEN value < 10 THEN 0 ELSE CAST(round(value * 100) AS BIGINT) END AS bytes
  FROM events)
"""


def _top_sql(column: str) -> str:
    return f"{_FIELDS} SELECT {column}, count(*) AS n FROM log GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10"


def _count_sql(column: str) -> str:
    return f"{_FIELDS} SELECT {column}, count(*) AS n FROM log GROUP BY 1 ORDER BY 1"


ORACLE = {
    "log_scan_count": "SELECT count(*) AS n FROM events",
    "log_parse": f"{_FIELDS} SELECT host, stamp, day, method, resource, status, bytes FROM log",
    "log_top_resources": _top_sql("resource"),
    "log_top_origins": _top_sql("host"),
    "log_methods_distinct": f"{_FIELDS} SELECT DISTINCT method FROM log ORDER BY 1",
    "log_status_codes": f"{_FIELDS} SELECT DISTINCT status FROM log ORDER BY 1",
    "log_method_counts": _count_sql("method"),
    "log_status_counts": _count_sql("status"),
    "log_requests_by_day": _count_sql("day"),
    "log_avg_bytes": f"""{_FIELDS}
        SELECT method, CAST(sum(bytes) // count(*) AS BIGINT) AS avg_bytes
        FROM log GROUP BY 1 ORDER BY 1""",
    "log_status_by_method": f"""{_FIELDS}
        SELECT method, string_agg(DISTINCT status, ',' ORDER BY status) AS statuses,
               CAST(0 AS BIGINT) AS n_other
        FROM log GROUP BY 1 ORDER BY 1""",
    "substring_counts": """
        SELECT CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS n_click,
               CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS n_view,
               CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n_error
        FROM events""",
}
