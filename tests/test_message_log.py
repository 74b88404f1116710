"""Messages with attributes, and tables that a stream appends to once."""

import glob
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowkit.functions import text
from flowkit.plans import stream_jobs
from flowkit.sinks.messages import start_append
from flowkit.sources.messagelog import _LogReader, publish_messages, read_message_log
from flowkit.streaming.ledger import TableFolder, read_table_folder, start_table_append
from flowkit.streaming.windows import tumbling_count, with_event_time
from tests.conftest import rows

START = datetime(2024, 1, 1)


def publish(spark, path, pairs):
    """Messages from ``(attribute, text)`` pairs, published at one time."""
    frame = spark.createDataFrame([(t, a) for a, t in pairs], "t string, a string")
    return publish_messages(frame, path, text.encode(F.col("t")), {"ts": F.col("a"), "k": F.lit("v")}, F.lit(START))


def at(seconds):
    return (START + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


def test_time_is_what_the_attribute_says(spark, tmp_path):
    log = f"{tmp_path}/log"
    millis = str(int((START - datetime(1970, 1, 1)).total_seconds() * 1000) + 250)
    assert publish(spark, log, [(at(3), "a"), (millis, "b"), ("soon", "c"), (None, "d")]) == 1

    def read(name, attribute):
        stream = read_message_log(spark, log, attribute).select(text.decode(F.col("value")).alias("t"), "ts")
        start_append(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}-state", available_now=True).awaitTermination()
        found = spark.read.parquet(f"{tmp_path}/{name}")
        return rows(found.select("t", F.col("ts").cast("timestamp_ntz")))

    assert read("said", "ts") == [
        ("a", START + timedelta(seconds=3)), ("b", START + timedelta(milliseconds=250)), ("c", None), ("d", None)
    ]
    assert read("published", None) == [(t, START) for t in "abcd"]
    assert read("other", "missing") == [(t, None) for t in "abcd"]


def test_a_query_goes_on_where_it_was(spark, tmp_path):
    log, out, state = (f"{tmp_path}/{n}" for n in ("log", "out", "state"))

    def run():
        stream = read_message_log(spark, log, "ts").select(text.decode(F.col("value")).alias("t"))
        start_append(stream, out, state, available_now=True).awaitTermination()
        return [r.t for r in spark.read.schema("t string").parquet(out).collect()]

    publish(spark, log, [(at(0), "a"), (at(1), "b")])
    assert sorted(run()) == ["a", "b"]
    assert sorted(run()) == ["a", "b"]
    publish(spark, log, [(at(2), "c")])
    publish(spark, log, [(at(3), "d")])
    assert sorted(run()) == ["a", "b", "c", "d"]


def test_a_batch_that_crashed_is_read_again_as_it_was(spark, tmp_path):
    log, state = f"{tmp_path}/log", f"{tmp_path}/state"
    publish(spark, log, [(at(0), "a"), (at(1), "b")])
    seen, crash = [], [True]

    def take(batch, number):
        seen.append((number, sorted(r.t for r in batch.collect())))
        if number == 1 and crash[0]:
            raise RuntimeError("lost")

    def run():
        stream = read_message_log(spark, log, "ts").select(text.decode(F.col("value")).alias("t"))
        query = stream.writeStream.foreachBatch(take).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()

    run()
    publish(spark, log, [(at(2), "c")])
    with pytest.raises(Exception, match="lost"):
        run()
    # What comes in after the crash is no part of the batch that is read again.
    publish(spark, log, [(at(3), "d")])
    crash[0] = False
    run()
    assert seen == [(0, ["a", "b"]), (1, ["c"]), (1, ["c"]), (2, ["d"])]


def test_offsets_and_partitions(spark, tmp_path):
    log = f"{tmp_path}/log"
    reader = _LogReader(log, 0)
    assert reader.latestOffset() == reader.initialOffset() == {"run": 0}
    for n in (1, 2, 3):
        frame = spark.range(0, 40, 1, n).selectExpr("CAST(id AS STRING) AS t")
        assert publish_messages(frame, f"file:{log}", text.encode(F.col("t"))) == n
    assert reader.latestOffset() == {"run": 3}
    files = [p.path for p in reader.partitions({"run": 1}, {"run": 3})]
    assert len(files) == 5 and files == [p.path for p in reader.partitions({"run": 1}, {"run": 3})]
    assert sum(b.num_rows for p in reader.partitions({"run": 0}, {"run": 3}) for b in reader.read(p)) == 120
    assert _LogReader(log, 2).initialOffset() == {"run": 2}


def test_a_run_that_failed_does_not_show(spark, tmp_path):
    log = f"{tmp_path}/log"
    publish(spark, log, [(at(0), "a")])
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken")).cast("string")).otherwise("x").alias("t"))
    with pytest.raises(Exception, match="broken"):
        publish_messages(bad, log, text.encode(F.col("t")))
    reader = _LogReader(log, 0)
    assert reader.latestOffset() == {"run": 1}
    assert publish(spark, log, [(at(1), "b")]) == 2
    assert sum(b.num_rows for p in reader.partitions({"run": 1}, {"run": 2}) for b in reader.read(p)) == 1


def counts(stream):
    return stream_jobs.word_count_rows(stream)


SCHEMA = "word string, count int, window_start timestamp, window_end timestamp"


def schema(spark, ddl=SCHEMA):
    return spark.createDataFrame([], ddl).schema


def table_rows(spark, path):
    return rows(read_table_folder(spark, path).select("word", "count"))


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_crash_doubles_and_loses_nothing(spark, tmp_path, when, monkeypatch):
    """The query ends between writing and renaming a batch, or just behind the rename."""
    log, out, state = (f"{tmp_path}/{n}" for n in ("log", "out", "state"))
    crashes = [True]

    def crash():
        if crashes.pop() if crashes else False:
            raise RuntimeError("lost")

    if when == "after":
        plain = TableFolder.append
        monkeypatch.setattr(TableFolder, "append", lambda *args: (plain(*args[:3]), crash())[0])

    def run():
        stream = read_message_log(spark, log, "ts")
        start_table_append(
            counts(stream), schema(spark), out, state, available_now=True, before_commit=crash if when == "before" else None
        ).awaitTermination()

    publish(spark, log, [(at(0), "a b a"), (at(130), "c")])
    with pytest.raises(Exception, match="lost"):
        run()
    # Readers see whole batches or nothing.
    assert table_rows(spark, out) in ([], [("a", 2), ("b", 1)])
    for _ in range(2):
        run()
    assert table_rows(spark, out) == [("a", 2), ("b", 1)]
    publish(spark, log, [(at(500), "")])
    run()
    assert table_rows(spark, out) == [("a", 2), ("b", 1), ("c", 1)]
    assert read_table_folder(spark, out).schema == schema(spark)


def test_a_table_is_declared_once(spark, tmp_path):
    out = f"{tmp_path}/out"
    table = TableFolder(spark, out)
    table.declare(schema(spark))
    table.declare(schema(spark))
    assert table.read().collect() == [] and table.read().schema == schema(spark)
    with pytest.raises(ValueError, match="the table has"):
        table.declare(schema(spark, "word string"))
    rows_in = spark.createDataFrame([("a", 1, START, START)], SCHEMA)
    assert table.append(rows_in, "x-1") and not table.append(rows_in, "x-1") and table.append(rows_in, "y-1")
    assert table.batches() == ["x-1", "y-1"] and table.read().count() == 2
    assert not glob.glob(f"{out}/_staged/x-1") and os.path.exists(f"{out}/batch=x-1")


def test_two_writers_and_unfit_values(spark, tmp_path):
    out = f"{tmp_path}/out"
    kind = schema(spark, "n int")
    for name in ("one", "two"):
        publish(spark, f"{tmp_path}/{name}", [(at(0), "1"), (at(1), "x")])
        stream = read_message_log(spark, f"{tmp_path}/{name}").select(text.decode(F.col("value")).alias("n"))
        start_table_append(
            stream, kind, out, f"{tmp_path}/{name}-state", writer=name, strict=False, available_now=True
        ).awaitTermination()
    assert rows(read_table_folder(spark, out)) == [(1,), (1,)]
    with pytest.raises(Exception, match="no int for n: x"):
        stream = read_message_log(spark, f"{tmp_path}/one").select(text.decode(F.col("value")).alias("n"))
        start_table_append(stream, kind, out, f"{tmp_path}/state", writer="three", available_now=True).awaitTermination()
    assert rows(read_table_folder(spark, out)) == [(1,), (1,)]


def test_windows_over_attribute_times(spark, tmp_path):
    log, out, state = (f"{tmp_path}/{n}" for n in ("log", "out", "state"))
    for pairs in ([(at(5), "a"), (at(1), "a")], [(at(20), "b"), (at(2), "late")], [(at(60), "c")]):
        publish(spark, log, pairs)
        stream = with_event_time(read_message_log(spark, log, "ts"), "ts")
        words = tumbling_count(stream.select("ts", text.decode(F.col("value")).alias("w")), "w", "ts", "10 seconds")
        start_append(words.select("w", "n"), out, state, available_now=True).awaitTermination()
    assert rows(spark.read.parquet(out)) == [("a", 2), ("b", 1), ("late", 1)]
