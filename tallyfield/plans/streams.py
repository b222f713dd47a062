"""Streaming summaries of the events table, replayed from delimited files."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from tallyfield.sources import load_table, scratch_dir, write_delimited
from tallyfield.sources.schemas import SCHEMAS
from tallyfield.streaming import (
    borrow_schema, run_to_memory, run_to_table, start_memory, start_table, stream_delimited)
from tallyfield.streaming.summaries import by_count, filtered_totals, type_summary

MICRO_BATCHES = 4


def event_stream(spark, sf, borrow: bool = False):
    """The events in ``MICRO_BATCHES`` micro-batches of the files that were written."""
    events = load_table(spark, sf, "events").select("event_id", "event_type", "user_id", "value")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = write_delimited(events.repartition(parts, "event_id"), scratch_dir(spark, "events"))
    files = spark.read.text(folder).select(F.input_file_name().alias("f")).distinct().count()
    schema = borrow_schema(spark, folder) if borrow else SCHEMAS["events"]
    return stream_delimited(
        spark, folder, schema, files_per_trigger=math.ceil(files / MICRO_BATCHES), mode="FAILFAST")


def stream_type_summary(spark, sf):
    """Event types are few by nature, so the memory sink holds the result."""
    stream = event_stream(spark, sf, borrow=True)
    summary = by_count(type_summary(stream, "event_type", "value"), "event_type")
    return run_to_memory(summary, "type_summary")


def stream_filtered_totals(spark, sf):
    """Users grow with the data, so the result is written from the executors."""
    totals = filtered_totals(event_stream(spark, sf), "event_type", "purchase", "user_id", "value")
    result = run_to_table(totals, "purchase_totals")
    return result.withColumn("total_amount", F.round("total_amount", 2)).orderBy(
        F.col("n").desc(), "user_id")


def stream_two_at_once(spark, sf):
    """Both summaries of one source as queries that run at the same time."""
    stream = event_stream(spark, sf)
    by_type, types = type_summary(stream, "event_type", "value"), f"types_{uuid.uuid4().hex}"
    by_user = filtered_totals(stream, "event_type", "purchase", "user_id", "value")
    folder, written = scratch_dir(spark, "purchase-totals"), []
    running = [
        start_memory(by_type, types, available_now=True),
        start_table(by_user, f"users_{uuid.uuid4().hex}", folder, available_now=True, written=written),
    ]
    for query in running:
        query.awaitTermination()
    users = spark.read.schema(by_user.schema).parquet(f"{folder}/batch={written[-1]}") if written \
        else spark.createDataFrame([], by_user.schema)
    return spark.table(types).select(F.lit("type").alias("of"), F.col("event_type").alias("key"), "n").unionAll(
        users.select(F.lit("user"), F.col("user_id").cast("string"), "n"))


QUERIES = {
    "stream_two_at_once": stream_two_at_once,
    "stream_type_summary": stream_type_summary,
    "stream_filtered_totals": stream_filtered_totals,
}

ORACLE = {
    "stream_two_at_once": """
        SELECT 'type' AS "of", event_type AS key, count(*) AS n FROM events GROUP BY 2
        UNION ALL
        SELECT 'user', user_id::VARCHAR, count(*) FROM events WHERE event_type = 'purchase' GROUP BY 2""",
    "stream_type_summary": """
        SELECT event_type, count(*) AS n, round(avg(value) + 1e-9, 2) AS avg_amount,
               min(value) AS min_amount, max(value) AS max_amount
        FROM events GROUP BY 1""",
    "stream_filtered_totals": """
        SELECT user_id, count(*) AS n, round(sum(CAST(value AS DECIMAL(28,4)))::DOUBLE, 2) AS total_amount,
               round(avg(value) + 1e-9, 2) AS avg_amount
        FROM events WHERE event_type = 'purchase' GROUP BY 1""",
}
