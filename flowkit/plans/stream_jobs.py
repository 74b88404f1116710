"""Windowed counts and SQL over message streams.

Each transformation takes a batch of ``value`` and ``ts`` as well as a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowkit.functions import text
from flowkit.functions.jsonrow import to_json_text
from flowkit.functions.times import RFC3339
from flowkit.operators.parse import Parsed, parse_json_rows
from flowkit.operators.sqlframe import sql_transform
from flowkit.sinks.messages import start_append, start_publish
from flowkit.streaming.windows import bounds_as_text, tumbling_count, with_event_time

# Window sizes and the statement over ride messages, here with
# the window as a grouping key.
WORD_WINDOW = "15 seconds"
TABLE_WINDOW = "2 minutes"
RIDE_FIELDS = {"ride_status": "text", "passenger_count": "int"}
RIDE_QUERY = """
    SELECT ride_status,
           COUNT(*) AS num_rides,
           SUM(passenger_count) AS total_passengers,
           window.start AS window_start,
           window.end AS window_end
    FROM {rows}
    WHERE NOT ride_status = 'enroute'
    GROUP BY ride_status, window(ts, '15 seconds')
"""


def _words(messages: DataFrame, pattern: str, delay: str) -> DataFrame:
    dated = with_event_time(messages, "ts", delay)
    line = text.decode(F.col("value"))
    return dated.select("ts", F.explode(text.words(line, pattern)).alias("word"))


def word_counts(messages: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Words per 15 s window."""
    return _words(messages, text.UNICODE_WORD, delay).transform(tumbling_count, "word", "ts", WORD_WINDOW)


def word_count_rows(messages: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Words per 2 min window with its bounds, as rows for a table."""
    counts = _words(messages, text.ASCII_WORD, delay).transform(tumbling_count, "word", "ts", TABLE_WINDOW)
    return counts.withColumnRenamed("n", "count")


def ride_rows(messages: DataFrame, delay: str = "0 seconds", strict: bool = False) -> Parsed:
    """Rides of JSON messages with their event time, and the messages that are none."""
    return parse_json_rows(with_event_time(messages, "ts", delay), RIDE_FIELDS, keep=["ts"], strict=strict)


def ride_windows(
    messages: DataFrame, query: str = RIDE_QUERY, delay: str = "0 seconds", strict: bool = True
) -> DataFrame:
    """SQL over JSON ride messages, 15 s windows.

    A message that is no such ride fails the job. Without ``strict`` it is
    left out; ``ride_rows`` has those apart.
    """
    return sql_transform(ride_rows(messages, delay, strict).rows, query)


def ride_totals(
    messages: DataFrame, query: str = RIDE_QUERY, delay: str = "0 seconds", strict: bool = True
) -> DataFrame:
    """``ride_windows`` with the bounds as text in RFC 3339."""
    return ride_windows(messages, query, delay, strict).transform(bounds_as_text, RFC3339)


def still_open(windows: DataFrame, messages: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Of the windows of a table, those that a stream over it has not given out when it ends.

    A stream gives a window out when the watermark has passed its end, and
    drops no row of a window still open. So after a finite run these rows,
    next to what the stream wrote, are all windows; the checkpoint stays as
    it is, and a later run gives them out again with what came in since.
    """
    watermark = messages.agg(F.max("ts") - F.expr(f"INTERVAL {delay}")).scalar()
    return windows.where(F.col("window_end") > watermark)


def word_line() -> Column:
    return text.count_line(F.col("word"), F.col("n"))


def start_word_count(
    messages: DataFrame, checkpoint: str, delay: str = "0 seconds", available_now: bool = False, **target: str
) -> StreamingQuery:
    """Publish ``word: n`` messages; ``target`` is a path, or a topic and its servers."""
    line = text.encode(word_line())
    return start_publish(word_counts(messages, delay), line, checkpoint, available_now=available_now, **target)


def start_word_table(
    messages: DataFrame, path: str, checkpoint: str, delay: str = "0 seconds", available_now: bool = False
) -> StreamingQuery:
    return start_append(word_count_rows(messages, delay), path, checkpoint, available_now)


def start_ride_totals(
    messages: DataFrame,
    checkpoint: str,
    delay: str = "0 seconds",
    available_now: bool = False,
    strict: bool = True,
    **target: str,
) -> StreamingQuery:
    """Publish one JSON message per status and window; see ``ride_windows`` for ``strict``."""
    totals = ride_totals(messages, delay=delay, strict=strict)
    value = text.encode(to_json_text(*totals.columns))
    return start_publish(totals, value, checkpoint, available_now=available_now, **target)


def start_ride_rejects(
    messages: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append the messages that are no ride to a folder, next to a run that is not strict."""
    return start_append(ride_rows(messages).rejects, path, checkpoint, available_now)
