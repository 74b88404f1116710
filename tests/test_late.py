"""Windows whose late rows are handed out."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from flowkit.catalog import QUERIES, SQL
from flowkit.functions import text
from flowkit.sinks.messages import start_append
from flowkit.sources.messages import read_messages
from flowkit.streaming.late import CLOSED, LATE, count_with_late
from flowkit.streaming.replay import replay
from tests.compare import connect, difference

START = datetime(2024, 1, 1)


def run(spark, batches, delay="0 seconds"):
    slices = []
    for pairs in batches:
        stamped = [(t, None if s is None else START + timedelta(seconds=s)) for s, t in pairs]
        frame = spark.createDataFrame(stamped, "t string, ts timestamp")
        slices.append(frame.select(text.encode(F.col("t")).alias("value"), "ts"))

    def start(stream, path, state):
        words = stream.select(text.decode(F.col("value")).alias("w"), "ts")
        return start_append(count_with_late(words, "w", "ts", "10 seconds", delay), path, state, available_now=True)

    out = replay(slices, lambda path: read_messages(spark, path), start)
    found = spark.read.parquet(out).select("key", F.col("opens").cast("timestamp_ntz").alias("opens"), "n", "kind")
    return sorted((r.key or "", int((r.opens - START).total_seconds()), r.n, r.kind) for r in found.collect())


def test_late_rows_come_out_apart(spark):
    batches = [[(1, "a"), (2, "a"), (15, "b")], [(3, "a"), (4, "c"), (31, "a")], [(2, "a"), (16, "b"), (60, "x")], [(70, "x")]]
    got = run(spark, batches)
    # After the first batch the watermark is at 15 s: the windows up to 10 s are over.
    assert got == [
        ("a", 0, 1, LATE), ("a", 0, 1, LATE), ("a", 0, 2, CLOSED), ("a", 30, 1, CLOSED),
        ("b", 10, 1, CLOSED), ("b", 10, 1, LATE), ("c", 0, 1, LATE), ("x", 60, 1, CLOSED),
    ]
    # All rows but the one in the window that is still open.
    assert sum(n for _, _, n, _ in got) == sum(map(len, batches)) - 1


def test_a_delay_waits(spark):
    got = run(spark, [[(1, "a"), (15, "b")], [(3, "a")], [(45, "b")], [(2, "a"), (90, "z")]], "10 seconds")
    assert ("a", 0, 2, CLOSED) in got and ("a", 0, 1, LATE) in got and ("b", 10, 1, CLOSED) in got


def test_rows_without_time_or_key(spark):
    got = run(spark, [[(None, "a"), (1, None), (1, "")], [(50, "z")]])
    assert sum(n for k, _, n, _ in got if k != "z") == 2


PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def test_late_rows_in_a_session_of_other_settings(spark, tmp_path):
    before = spark.conf.get(PROVIDER)
    memory = before.replace("RocksDBStateStore", "HDFSBackedStateStore")
    days = [0, 0.5, 0.5, 1.2, 3, None, 8.5, 9.25, None, 10]
    types = ["a", None, "", "a", None, "a", "", "b", None, "a"]
    # The last event is at midnight.
    stamped = [(t, None if d is None else START + timedelta(days=d)) for t, d in zip(types, days)]
    try:
        spark.conf.set(PROVIDER, memory)
        for name, events in (("some", stamped), ("none", []), ("untimed", [("a", None)])):
            folder = f"{tmp_path}/{name}"
            frame = spark.createDataFrame(events, "event_type string, ts timestamp_ntz")
            frame.coalesce(1).write.parquet(f"{folder}/written")
            (part,) = (tmp_path / name / "written").glob("part-*.parquet")
            part.rename(f"{folder}/events.parquet")
            got = QUERIES["stream_late_rows"](spark, folder)
            assert difference(got, connect(folder), SQL["stream_late_rows"]) is None, name
            assert spark.conf.get(PROVIDER) == memory
    finally:
        spark.conf.set(PROVIDER, before)
