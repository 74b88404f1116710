"""Windows on tables and streams."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowkit.functions import text
from flowkit.plans import stream_jobs
from flowkit.sinks.messages import start_publish
from flowkit.sources.messages import read_messages, record_time
from flowkit.session import materialize
from flowkit.streaming.replay import replay, time_slices
from flowkit.streaming.windows import bounds_as_text, tumbling_agg, with_event_time
from tests.conftest import rows

START = datetime(2024, 1, 1)


@pytest.fixture
def messages(spark):
    def make(pairs):
        """Messages from ``(seconds, text)`` pairs."""
        frame = spark.createDataFrame(
            [(t, START + timedelta(seconds=s)) for s, t in pairs], "t string, ts timestamp"
        )
        return frame.select(text.encode(F.col("t")).alias("value"), "ts")

    return make


def run(spark, batches, start, **options):
    return replay(
        batches,
        lambda path: read_messages(spark, path),
        lambda stream, path, state: start(stream, path=path, checkpoint=state, available_now=True, **options),
    )


def published(spark, path):
    frame = spark.read.schema("value binary").parquet(path)
    return sorted(r[0] for r in frame.select(text.decode(F.col("value"))).collect())


def test_stream_gives_out_closed_windows(spark, messages):
    batches = [messages([(0, "a b"), (14, "a")]), messages([(16, "a"), (31, "c")])]
    path = run(spark, batches, stream_jobs.start_word_count)
    assert published(spark, path) == ["a: 1", "a: 2", "b: 1"]


def test_empty_text_counts_nothing(spark, messages):
    assert stream_jobs.word_counts(messages([(0, ""), (1, " . ")])).count() == 0


def test_late_rows_are_dropped(spark, messages):
    batches = [messages([(0, "a")]), messages([(40, "b")]), messages([(1, "a"), (41, "b")]), messages([(60, "c")])]
    path = run(spark, batches, stream_jobs.start_word_count)
    assert published(spark, path) == ["a: 1", "b: 2"]


def test_delay_waits_for_late_rows(spark, messages):
    batches = [messages([(0, "a")]), messages([(40, "b")]), messages([(1, "a"), (41, "b")]), messages([(90, "c")])]
    path = run(spark, batches, stream_jobs.start_word_count, delay="30 seconds")
    assert published(spark, path) == ["a: 2", "b: 2"]


def test_open_windows_complete_a_finite_run(spark, messages):
    table = messages([(0, "a b"), (16, "a"), (44, "c")])
    path = run(spark, [table], stream_jobs.start_word_count)
    left = stream_jobs.still_open(stream_jobs.word_counts(table), table)
    lines = [r[0] for r in left.select(stream_jobs.word_line()).collect()]
    assert sorted(published(spark, path) + lines) == ["a: 1", "a: 1", "b: 1", "c: 1"]
    assert lines == ["c: 1"]
    # The watermark is where the rows left it: what comes next is not late.
    path = run(spark, [table, messages([(44, "d"), (61, "e")])], stream_jobs.start_word_count)
    assert published(spark, path) == ["a: 1", "a: 1", "b: 1", "c: 1", "d: 1"]


def test_a_message_that_is_no_ride(spark, messages):
    rides = messages([(0, ride("pickup", 2)), (1, "no json"), (2, ride("pickup", '"1_000"')), (20, ride("x", 2**70))])
    with pytest.raises(Exception, match="row does not fit"):
        run(spark, [rides], stream_jobs.start_ride_totals)
    with pytest.raises(Exception, match="row does not fit"):
        stream_jobs.ride_totals(rides).collect()
    totals = stream_jobs.ride_totals(rides, strict=False).collect()
    assert [(r.num_rides, r.total_passengers) for r in totals] == [(2, 1002)]
    path = run(spark, [rides], stream_jobs.start_ride_rejects)
    assert published(spark, path) == sorted(["no json", ride("x", 2**70)])


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_bounds_are_utc_in_any_session(spark, messages, zone):
    # Around both changes of the clocks in New York.
    starts = [datetime(2024, 3, 10, 1, 59, 50), datetime(2024, 3, 10, 6, 59, 50), datetime(2024, 11, 3, 5, 59, 50)]
    pairs = [((s - START).total_seconds() + d, ride("x", 1)) for s in starts for d in range(0, 7300, 600)]
    table = materialize(messages(pairs), "zones")
    want = rows(stream_jobs.ride_totals(table))
    words = rows(stream_jobs.word_count_rows(table).transform(bounds_as_text))
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert rows(stream_jobs.ride_totals(table)) == want
        assert rows(stream_jobs.word_count_rows(table).transform(bounds_as_text)) == words
        path = run(spark, [table], stream_jobs.start_ride_totals)
        lines = published(spark, path)
        assert len(lines) == len(want) - 1 and all("T" in x and "Z" in x for x in lines)
        starts = {json.loads(x)["window_start"] for x in lines}
        assert starts < {r[-2] for r in want}
        assert spark.conf.get("spark.sql.session.timeZone") == zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert any("2024-03-10T02:" in r[-2] for r in want)


def ride(status, count):
    return f'{{"ride_status": "{status}", "passenger_count": {count}}}'


def test_filtered_rows_advance_the_watermark(spark, messages):
    batches = [
        messages([(0, ride("pickup", 2)), (1, ride("pickup", 3)), (2, ride("enroute", 9)), (3, "no json")]),
        messages([(20, ride("enroute", 1))]),
    ]
    path = run(spark, batches, stream_jobs.start_ride_totals, strict=False)
    assert published(spark, path) == [
        '{"ride_status":"pickup","num_rides":2,"total_passengers":5,'
        '"window_start":"2024-01-01T00:00:00Z","window_end":"2024-01-01T00:00:15Z"}'
    ]


def test_rows_without_words_advance_the_watermark(spark, messages):
    path = run(spark, [messages([(0, "a")]), messages([(20, " ... ")])], stream_jobs.start_word_count)
    assert published(spark, path) == ["a: 1"]


def test_ride_totals_of_a_table(spark, messages):
    rides = messages([(0, ride("pickup", 2)), (16, ride("dropoff", 1)), (17, ride("enroute", 1))])
    found = stream_jobs.ride_totals(rides)
    assert rows(found.select("ride_status", "num_rides", "window_start")) == [
        ("dropoff", 1, "2024-01-01T00:00:15Z"),
        ("pickup", 1, "2024-01-01T00:00:00Z"),
    ]


def test_stream_equals_table_on_closed_windows(spark, messages):
    pairs = [(i * 7 % 400, f"w{i % 5} x") for i in range(200)]
    table = messages(pairs)
    path = run(spark, time_slices(table, "ts", 4), stream_jobs.start_word_table)
    last = max(s for s, _ in pairs)
    expected = stream_jobs.word_count_rows(table).where(
        F.col("window_end") <= F.lit(START + timedelta(seconds=last))
    )
    assert rows(spark.read.parquet(path)) == rows(expected)
    assert expected.count() > 0


def test_time_slices_cover_the_table(spark, messages):
    table = messages([(i, "t") for i in range(10)])
    parts = time_slices(table, "ts", 3)
    assert sum(p.count() for p in parts) == 10
    assert all(p.count() > 0 for p in parts)
    assert time_slices(table.limit(0), "ts", 3) == []


def test_tumbling_windows_start_at_the_epoch(spark):
    frame = spark.createDataFrame([("2024-01-01 23:59:59.999999", 1), ("2024-01-02", 2)], "ts string, v int")
    frame = frame.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    found = tumbling_agg(with_event_time(frame, "ts"), [], "ts", "1 day", F.sum("v").alias("v"))
    assert rows(found.select("v", F.date_format("window_start", "dd"))) == [(1, "01"), (2, "02")]


def test_message_source_arguments(spark):
    for wrong in ({}, {"path": "p", "topic": "t"}, {"topic": "t"}):
        with pytest.raises(ValueError):
            read_messages(spark, **wrong)


def test_message_sink_arguments(spark):
    for wrong in ({}, {"path": "p", "topic": "t"}, {"topic": "t"}):
        with pytest.raises(ValueError):
            start_publish(spark.range(1), F.lit("x"), "state", **wrong)


def test_record_time_from_a_header(spark):
    headers = [
        [("ts", b"2024-01-01T00:00:15.25Z")],
        [("ts", b"1704067215250")],
        [("x", b"1"), ("ts", b"0"), ("ts", b"1704067215250")],
        [("ts", b"soon")],
        [("x", b"1")],
        None,
    ]
    frame = spark.createDataFrame(
        [(START, h) for h in headers], "timestamp timestamp, headers array<struct<key string, value binary>>"
    )
    moment = START + timedelta(seconds=15, milliseconds=250)
    found = [r[0] for r in frame.select(record_time("ts").cast("timestamp_ntz")).collect()]
    assert found == [moment, moment, moment, None, None, None]
    assert frame.select(record_time()).first()[0] == frame.first()[0]
