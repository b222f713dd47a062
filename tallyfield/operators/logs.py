"""Access log lines: ``host [DD:HH:MM:SS "METHOD resource" status bytes``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = 6


def parse_access_log(lines: DataFrame, line: str = "line") -> DataFrame:
    """(host, stamp, day, method, resource, status, bytes, n_tokens) per line.

    Quotes are removed and the line is split at single spaces. The byte count is the last token,
    with ``-`` read as 0. A field that is missing or does not parse is NULL.
    """
    parts = F.split(F.translate(F.col(line), '"', ""), " ")
    last = F.element_at("parts", -1)
    return lines.select(parts.alias("parts")).select(
        F.get("parts", 0).alias("host"),
        F.get("parts", 1).alias("stamp"),
        F.substring(F.get("parts", 1), 2, 2).alias("day"),
        F.get("parts", 2).alias("method"),
        F.get("parts", 3).alias("resource"),
        F.get("parts", 4).alias("status"),
        F.when(last == "-", F.lit(0)).otherwise(last.try_cast("bigint")).alias("bytes"),
        F.size("parts").alias("n_tokens"),
    )


def malformed(parsed: DataFrame) -> DataFrame:
    """Parsed lines without exactly six tokens or without a byte count."""
    return parsed.filter((F.col("n_tokens") != FIELDS) | F.col("bytes").isNull())


def mean_bytes(parsed: DataFrame, key: str = "method") -> DataFrame:
    """(key, avg_bytes): the mean truncated to a whole number. Empty transfers count."""
    return parsed.groupBy(key).agg(F.expr("sum(bytes) div count(bytes)").alias("avg_bytes"))


def status_sets(parsed: DataFrame, key: str = "method") -> DataFrame:
    """(key, statuses, n_other): all distinct statuses in order, joined by commas.

    Duplicates are dropped before anything is gathered, so a list holds each status once, whatever
    it looks like; n_other counts those that are no three-digit codes. ``status_pairs`` has the
    same in long form.
    """
    is_code = F.col("status").rlike("^[0-9]{3}$")
    return status_pairs(parsed, key).groupBy(key).agg(
        F.array_join(F.sort_array(F.collect_list("status")), ",").alias("statuses"),
        F.count_if(~is_code).alias("n_other"),
    )


def status_pairs(parsed: DataFrame, key: str = "method") -> DataFrame:
    """Distinct (key, status)."""
    return parsed.select(key, "status").distinct()


def distinct_values(parsed: DataFrame, column: str) -> DataFrame:
    return parsed.select(column).distinct().orderBy(column)
