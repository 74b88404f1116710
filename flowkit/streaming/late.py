"""Windowed counts that hand out late rows instead of dropping them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from flowkit.session import state_in_rocksdb
from flowkit.sinks.messages import start_append
from flowkit.streaming.windows import with_event_time

#: Kinds of rows that come out.
CLOSED, LATE = "closed", "late"
_OUT = "key string, opens timestamp, closes timestamp, n long, kind string"


class _WindowCounts(StatefulProcessor):
    """The count of one key and window: kept until the watermark passes the window's end, then given out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        word, opens, closes = key
        arrived = sum(len(part) for part in rows)
        if timerValues.getCurrentWatermarkInMs() >= closes:
            yield _row(word, opens, closes, arrived, LATE)
            return
        if self.count.exists():
            arrived += self.count.get()[0]
        else:
            self.handle.registerTimer(closes)
        self.count.update((arrived,))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        word, opens, closes = key
        yield _row(word, opens, closes, self.count.get()[0], CLOSED)
        self.count.clear()

    def close(self) -> None:
        pass


def _row(word: str, opens: int, closes: int, n: int, kind: str) -> pd.DataFrame:
    bounds = [pd.Timestamp(x, unit="ms", tz="UTC") for x in (opens, closes)]
    return pd.DataFrame({"key": [word], "opens": [bounds[0]], "closes": [bounds[1]], "n": [n], "kind": [kind]})


def count_with_late(df: DataFrame, key: str, ts: str, size: str, delay: str = "0 seconds") -> DataFrame:
    """Rows of a stream per key and tumbling window: ``key``, ``opens``, ``closes``, ``n``, ``kind``.

    A window comes out once as ``closed``, when the watermark passes its end.
    Rows that arrive after that come out as ``late``, with how many of them a
    batch has brought; a window none of whose rows was in time has only late
    ones. So the sum of ``n`` is the number of rows, but for windows still
    open. Keys are text, window bounds whole milliseconds; rows without an
    event time are left out. The count of one window and key is the state;
    it has a timer, so the stream has to start in a session that keeps state
    in RocksDB, as ``start_count_with_late`` sees to.
    """
    dated = with_event_time(df, ts, delay)
    window = F.window(ts, size)
    bounds = [F.unix_millis(window.getField(b)).alias(b) for b in ("start", "end")]
    # Only numbers go on: a column with a watermark would have its late rows filtered before they are seen.
    rows = dated.where(F.col(ts).isNotNull()).select(F.col(key).cast("string").alias("key"), *bounds)
    return rows.groupBy("key", "start", "end").transformWithStateInPandas(
        statefulProcessor=_WindowCounts(), outputStructType=_OUT, outputMode="Append", timeMode="EventTime"
    )


def start_count_with_late(
    df: DataFrame,
    key: str,
    ts: str,
    size: str,
    path: str,
    checkpoint: str,
    delay: str = "0 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Append what ``count_with_late`` gives out to a parquet folder, in a session of any settings."""
    with state_in_rocksdb(df.sparkSession):
        return start_append(count_with_late(df, key, ts, size, delay), path, checkpoint, available_now)
