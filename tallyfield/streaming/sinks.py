"""Sinks for complete results.

The memory sink keeps the whole result on the driver: use it where the number of groups is small
by nature. The table sink writes each complete result from the executors to a folder of its own
and suits any number of groups.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyfield.sources.scratch import scratch_dir


def _writer(result: DataFrame, name: str, available_now: bool, checkpoint: str | None):
    checkpoint = checkpoint or scratch_dir(result.sparkSession, f"{name}-checkpoint")
    writer = result.writeStream.outputMode("complete").queryName(name)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if available_now else writer


def _start(writer, spark: SparkSession, partitions: int | None) -> StreamingQuery:
    """Start with a number of state partitions. A query keeps the number it starts with, so the
    session setting is put back at once."""
    if partitions is None:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


def start_memory(
    result: DataFrame, name: str, available_now: bool = False, partitions: int | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Start a query whose complete result is the in-memory table ``name``.

    A query started again with the same ``checkpoint`` goes on where it stopped.
    """
    writer = _writer(result, name, available_now, checkpoint).format("memory")
    return _start(writer, result.sparkSession, partitions)


def start_table(
    result: DataFrame, name: str, folder: str, available_now: bool = False,
    written: list[int] | None = None, partitions: int | None = None, checkpoint: str | None = None,
) -> StreamingQuery:
    """Start a query that writes each complete result to ``folder/batch=<id>``.

    A batch that is run again after a failure replaces its own folder. ``written`` collects the
    ids of finished batches. A query started again with the same ``checkpoint`` and folder goes on
    where it stopped.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        if written is not None:
            written.append(batch_id)

    writer = _writer(result, name, available_now, checkpoint).foreachBatch(write)
    return _start(writer, result.sparkSession, partitions)


def run_to_memory(result: DataFrame, label: str, partitions: int | None = None) -> DataFrame:
    """Process what is there now; the result is the in-memory table of a fresh name."""
    name = f"{label}_{uuid.uuid4().hex}"
    start_memory(result, name, True, partitions).awaitTermination()
    return result.sparkSession.table(name)


def run_to_table(result: DataFrame, label: str, partitions: int | None = None) -> DataFrame:
    """Process what is there now; the result is read back from the last batch written."""
    spark = result.sparkSession
    folder = scratch_dir(spark, label)
    written: list[int] = []
    name = f"{label}_{uuid.uuid4().hex}"
    start_table(result, name, folder, True, written, partitions).awaitTermination()
    if not written:
        return spark.createDataFrame([], result.schema)
    return spark.read.schema(result.schema).parquet(f"{folder}/batch={written[-1]}")
