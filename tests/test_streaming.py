"""Streams against the same summaries run as a batch."""

import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallyfield import streaming
from tallyfield.sources import read_delimited, scratch_dir, write_delimited
from tallyfield.sources.schemas import SCHEMAS
from tallyfield.streaming import summaries


@pytest.fixture(scope="module")
def folder(spark, small_sf):
    events = spark.read.parquet(f"{small_sf}/events.parquet")
    rows = events.select("event_id", "event_type", "user_id", "value").repartition(4, "event_id")
    return write_delimited(rows, scratch_dir(spark, "test-events"))


def batch(spark, folder):
    return read_delimited(spark, folder, "events")


def rows(df, columns):
    return sorted(map(tuple, df.select(columns).collect()))


def test_borrowed_schema(spark, folder):
    schema = streaming.borrow_schema(spark, folder)
    assert schema.names == ["event_id", "event_type", "user_id", "value"]
    stream = streaming.stream_delimited(spark, folder, schema)
    assert stream.isStreaming


def test_two_queries_over_one_source_at_once(spark, folder):
    stream = streaming.stream_delimited(spark, folder, SCHEMAS["events"])
    by_type = summaries.by_count(summaries.type_summary(stream, "event_type", "value"), "event_type")
    totals = summaries.filtered_totals(stream, "event_type", "purchase", "user_id", "value")
    names = [f"t_{uuid.uuid4().hex}" for _ in range(2)]
    written = []
    target = scratch_dir(spark, "test-totals")
    queries = [
        streaming.start_memory(by_type, names[0], available_now=True),
        streaming.start_table(totals, names[1], target, available_now=True, written=written),
    ]
    for query in queries:
        query.awaitTermination()
        assert not query.isActive and query.exception() is None
    assert len(queries[0].recentProgress) >= 4 and len(written) == 4

    events = batch(spark, folder)
    expected = summaries.type_summary(events, "event_type", "value")
    assert rows(spark.table(names[0]), expected.columns) == rows(expected, expected.columns)
    shown = [r.n for r in spark.sql(f"SELECT * FROM {names[0]}").collect()]
    assert shown == sorted(shown, reverse=True)

    expected = summaries.filtered_totals(events, "event_type", "purchase", "user_id", "value")
    final = spark.read.parquet(f"{target}/batch={written[-1]}")
    kept = ["user_id", "n", "avg_amount"]
    assert rows(final, kept) == rows(expected, kept)


def test_running_query_can_be_watched_and_stopped(spark, folder):
    stream = streaming.stream_delimited(spark, folder, SCHEMAS["events"])
    name = f"t_{uuid.uuid4().hex}"
    query = streaming.start_memory(summaries.type_summary(stream, "event_type", "value"), name)
    query.processAllAvailable()
    assert query.isActive
    assert spark.table(name).agg(F.sum("n")).first()[0] == batch(spark, folder).count()
    query.stop()
    assert not query.isActive


def test_state_partitions_belong_to_the_query_alone(spark, folder):
    stream = streaming.stream_delimited(spark, folder, SCHEMAS["events"], files_per_trigger=4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    summary = summaries.type_summary(stream, "event_type", "value")
    query = streaming.start_memory(summary, f"t_{uuid.uuid4().hex}", True, partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3


def test_empty_source_gives_an_empty_result(spark, tmp_path):
    empty = write_delimited(spark.createDataFrame([], SCHEMAS["events"]), str(tmp_path / "none"))
    stream = streaming.stream_delimited(spark, empty, SCHEMAS["events"])
    totals = summaries.filtered_totals(stream, "event_type", "purchase", "user_id", "value")
    assert streaming.run_to_table(totals, "empty").count() == 0


def test_borrowed_types_cover_all_files(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("k,v\nx,1\ny,2\n")
    (folder / "b.csv").write_text("k,v\n")
    (folder / "c.csv").write_text("k,v\nx,3000000000.5\nz,560.21\n")
    schema = streaming.borrow_schema(spark, str(folder))
    assert schema["v"].dataType.typeName() == "double"
    stream = streaming.stream_delimited(spark, str(folder), schema, mode="FAILFAST")
    found = streaming.run_to_memory(summaries.type_summary(stream, "k", "v"), "mixed")
    assert {r.k: r.max_amount for r in found.collect()} == {"x": 3000000000.5, "y": 2.0, "z": 560.21}


def test_a_sample_without_rows_is_refused(spark, tmp_path):
    (tmp_path / "only-header.csv").write_text("k,v\n")
    with pytest.raises(ValueError):
        streaming.borrow_schema(spark, str(tmp_path))


def test_a_value_outside_the_types_stops_the_stream(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\nx,1\n")
    schema = streaming.borrow_schema(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text("k,v\nx,not a number\n")
    stream = streaming.stream_delimited(spark, str(tmp_path), schema, mode="FAILFAST")
    with pytest.raises(StreamingQueryException):
        streaming.run_to_memory(summaries.type_summary(stream, "k", "v"), "bad")


def test_a_restarted_query_goes_on(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("k,v\nx,1\n")
    written = []

    def run():
        stream = streaming.stream_delimited(spark, str(source), "k STRING, v INT")
        streaming.start_table(
            summaries.type_summary(stream, "k", "v"), f"t_{uuid.uuid4().hex}", str(tmp_path / "out"), True, written,
            checkpoint=str(tmp_path / "checkpoint")).awaitTermination()

    run()
    (source / "b.csv").write_text("k,v\nx,5\n")
    run()
    assert written == [0, 1]
    last = spark.read.parquet(str(tmp_path / "out" / "batch=1")).first()
    assert (last.n, last.max_amount) == (2, 5)
