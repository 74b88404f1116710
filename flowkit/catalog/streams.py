"""Windows over events, as a table and as a stream.

A stream gives a window out once the watermark has passed its end. A closing
message, which counts nothing itself, follows the last event a day later, so
that the stream gives out every window; only ``stream_late_drop`` goes without
it and keeps to the windows that the events close. It, ``stream_all_windows``
and ``stream_attribute_time`` replay the events in time order and restart from
the checkpoint in between.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.catalog.registry import query, table
from flowkit.functions import text
from flowkit.functions.jsonrow import to_json_text
from flowkit.functions.times import RFC3339
from flowkit.plans import stream_jobs
from flowkit.session import scratch_dir
from flowkit.sources.messagelog import publish_messages, read_message_log
from flowkit.sources.messages import read_messages
from flowkit.streaming.late import CLOSED, start_count_with_late
from flowkit.streaming.ledger import read_table_folder, start_table_append
from flowkit.streaming.replay import replay, time_slices
from flowkit.streaming.windows import bounds_as_text

_SLICES = 2

_CLOSED = "closes <= (SELECT max(ts) FROM events)"
_WORDS_15S = r"""
    SELECT unnest(regexp_extract_all(event_type || ' ' || props, '[\p{L}\p{N}_'']+')) AS word,
           time_bucket(INTERVAL 15 SECOND, ts) AS opens, opens + INTERVAL 15 SECOND AS closes FROM events
"""
_WORDS_2MIN = r"""
    SELECT unnest(regexp_extract_all(event_type || ' ' || props, '[A-Za-z'']+')) AS word,
           time_bucket(INTERVAL 2 MINUTE, ts) AS opens, opens + INTERVAL 2 MINUTE AS closes FROM events
"""
_WORD_TABLE = f"""
    SELECT word, count(*) AS count, strftime(opens, '%Y-%m-%d %H:%M:%S.%f UTC') AS window_start,
           strftime(closes, '%Y-%m-%d %H:%M:%S.%f UTC') AS window_end
    FROM ({_WORDS_2MIN}) WHERE {{kept}} GROUP BY word, opens, closes
"""
_RIDES = """
    SELECT event_type AS ride_status, count(*) AS num_rides,
           sum(json_extract_string(props, '$.k')::BIGINT)::BIGINT AS total_passengers,
           strftime(opens, '%Y-%m-%dT%H:%M:%SZ') AS window_start,
           strftime(closes, '%Y-%m-%dT%H:%M:%SZ') AS window_end
    FROM (SELECT *, time_bucket(INTERVAL 15 SECOND, ts) AS opens, opens + INTERVAL 15 SECOND AS closes FROM events)
    WHERE {kept} AND NOT event_type = 'view' GROUP BY event_type, opens, closes
"""


def _text_messages(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    line = F.concat_ws(" ", "event_type", "props")
    return events.select(text.encode(line).alias("value"), F.col("ts").cast("timestamp").alias("ts"))


def _ride_messages(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    # The statement over ride messages leaves out "enroute"; here that is "view".
    status = F.when(F.col("event_type") == "view", "enroute").otherwise(F.col("event_type"))
    ride = to_json_text(
        status.alias("ride_status"), F.get_json_object("props", "$.k").cast("bigint").alias("passenger_count")
    )
    return events.select(text.encode(ride).alias("value"), F.col("ts").cast("timestamp").alias("ts"))


def _closed(messages: DataFrame, value: str) -> DataFrame:
    """The messages and one more, a day after the last: all windows of the others are over then."""
    last = messages.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"))
    return messages.union(last.select(text.encode(F.lit(value)).alias("value"), "ts"))


def _run(spark: SparkSession, slices: list[DataFrame], start) -> str:
    """Replay into ``start(stream, checkpoint, path)``."""
    return replay(
        slices,
        partial(read_messages, spark),
        lambda stream, path, state: start(stream, checkpoint=state, path=path, available_now=True),
    )


@query(_WORD_TABLE.format(kept="true"))
def tumbling_word_count(spark: SparkSession, folder: str) -> DataFrame:
    return stream_jobs.word_count_rows(_text_messages(spark, folder)).transform(bounds_as_text)


@query(_RIDES.format(kept="true"))
def sql_window_agg(spark: SparkSession, folder: str) -> DataFrame:
    return stream_jobs.ride_totals(_ride_messages(spark, folder))


@query(f"SELECT word || ': ' || count(*) AS value FROM ({_WORDS_15S}) GROUP BY word, opens")
def stream_wordcount(spark: SparkSession, folder: str) -> DataFrame:
    out = _run(spark, [_closed(_text_messages(spark, folder), "")], stream_jobs.start_word_count)
    return spark.read.schema("value binary").parquet(out).select(text.decode(F.col("value")).alias("value"))


def _word_table(spark: SparkSession, slices: list[DataFrame]) -> DataFrame:
    out = _run(spark, slices, stream_jobs.start_word_table)
    schema = "word string, count bigint, window_start timestamp, window_end timestamp"
    return spark.read.schema(schema).parquet(out).transform(bounds_as_text)


@query(_WORD_TABLE.format(kept="true"))
def stream_word_table(spark: SparkSession, folder: str) -> DataFrame:
    return _word_table(spark, [_closed(_text_messages(spark, folder), "")])


def _slices(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The events in two halves by time, the closing message behind the second."""
    *first, last = time_slices(_text_messages(spark, folder), "ts", _SLICES)
    return [*first, _closed(last, "")]


@query(_WORD_TABLE.format(kept="true"))
def stream_all_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The same from two runs, the second from the first one's checkpoint."""
    return _word_table(spark, _slices(spark, folder))


@query(_WORD_TABLE.format(kept="true"))
def stream_attribute_time(spark: SparkSession, folder: str) -> DataFrame:
    """Event time from an attribute of the messages in a log; they are published at other times. Restarted once."""
    log, out, state = (scratch_dir(spark, f"log-{x}") for x in ("in", "out", "state"))
    said = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    for part in _slices(spark, folder):
        publish_messages(part, log, F.col("value"), {"ts": said}, F.timestamp_seconds(F.lit(0)))
        stream = read_message_log(spark, log, "ts")
        stream_jobs.start_word_table(stream, out, state, available_now=True).awaitTermination()
    schema = "word string, count bigint, window_start timestamp, window_end timestamp"
    return spark.read.schema(schema).parquet(out).transform(bounds_as_text)


@query(_WORD_TABLE.format(kept="true"))
def stream_append_table(spark: SparkSession, folder: str) -> DataFrame:
    """Windows appended to a declared table, each batch once, by a query that restarts."""
    rows = stream_jobs.word_count_rows(_text_messages(spark, folder).limit(0))
    slices = [part.select("value", "ts") for part in _slices(spark, folder)]
    out = replay(
        slices,
        partial(read_messages, spark),
        lambda stream, path, state: start_table_append(
            stream_jobs.word_count_rows(stream), rows.schema, path, state, available_now=True
        ),
    )
    return read_table_folder(spark, out).transform(bounds_as_text)


@query(_RIDES.format(kept="true"))
def stream_sql_window(spark: SparkSession, folder: str) -> DataFrame:
    rides = _closed(_ride_messages(spark, folder), '{"ride_status":"enroute","passenger_count":0}')
    out = _run(spark, [rides], stream_jobs.start_ride_totals)
    fields = "ride_status string, num_rides bigint, total_passengers bigint, window_start string, window_end string"
    messages = spark.read.schema("value binary").parquet(out)
    return messages.select(F.inline(F.array(F.from_json(text.decode(F.col("value")), fields))))


@query(_WORD_TABLE.format(kept=_CLOSED))
def stream_late_drop(spark: SparkSession, folder: str) -> DataFrame:
    """The first half of the events comes once more at the end, too late to count."""
    slices = time_slices(_text_messages(spark, folder), "ts", _SLICES)
    return _word_table(spark, [*slices, slices[0]])


# The first half of the events comes twice; of its second coming, windows that are still open take their rows as
# well, and the late rows of the others come out apart.
_HALF = "(SELECT min(ts) + to_microseconds((epoch_us(max(ts)) - epoch_us(min(ts))) // 2) FROM events)"


@query(f"""
    WITH twice AS (
        SELECT event_type, ts, 1 AS rows_in_time, 0 AS late FROM events
        UNION ALL SELECT event_type, ts, 0, 1 FROM events WHERE ts < {_HALF}
    )
    SELECT event_type, strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day,
           sum(rows_in_time)::BIGINT AS closed, sum(late)::BIGINT AS late
    FROM twice GROUP BY ALL
""")
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Daily counts; the first half of the events comes once more when its windows are closed, and is counted as late."""
    events = table(spark, folder, "events").select(
        text.encode(F.col("event_type")).alias("value"), F.col("ts").cast("timestamp").alias("ts")
    )
    # Events without a time are in no window and no day.
    whole = F.lit(1).cast("bigint").alias("n")
    untimed = events.where("ts IS NULL").select(
        text.decode(F.col("value")).alias("key"), F.col("ts").alias("opens"), whole, F.lit(CLOSED).alias("kind")
    )

    def start(stream, path, state):
        rows = stream.select(text.decode(F.col("value")).alias("type"), "ts")
        return start_count_with_late(rows, "type", "ts", "1 day", path, state, available_now=True)

    found, slices = untimed, time_slices(events, "ts", _SLICES)
    if slices:
        first, last = slices
        # The window of the closing message stays open, so it is not among the rows.
        out = replay([first, _closed(last, ""), first], partial(read_messages, spark), start)
        found = spark.read.schema("key string, opens timestamp, n bigint, kind string").parquet(out).unionByName(untimed)
    own = lambda kind: F.coalesce(F.sum(F.when(kind, F.col("n"))), F.lit(0))
    return found.groupBy(F.col("key").alias("event_type"), F.col("opens").cast("date").cast("string").alias("day")).agg(
        own(F.col("kind") == CLOSED).alias("closed"), own(F.col("kind") != CLOSED).alias("late")
    )
