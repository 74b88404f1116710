"""Tumbling event-time windows, the same on tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowkit.functions.times import MICROS_UTC, bound_text, event_time


def with_event_time(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Declare the event time; on a stream, how long late rows are waited for.

    Catalyst moves filters below a watermark, where the rows they drop no
    longer advance it. On a stream the other columns are therefore tied to the
    event time: a filter on them stays above, and a window closes once any
    later row has been read, whether or not it passes a filter.
    """
    df = df.withColumn(ts, event_time(F.col(ts)))
    if not df.isStreaming:
        return df
    dated = F.col(ts).isNotNull()
    return df.withWatermark(ts, delay).select(
        *[F.col(c) if c == ts else F.when(dated, F.col(c)).alias(c) for c in df.columns]
    )


def tumbling_agg(df: DataFrame, keys: list[str], ts: str, size: str, *aggregates: Column) -> DataFrame:
    """Aggregates per key and window; the window bounds become two columns."""
    windowed = df.groupBy(F.window(ts, size), *keys).agg(*aggregates)
    rest = [c for c in windowed.columns if c != "window"]
    return windowed.select(
        *rest, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")
    )


def tumbling_count(df: DataFrame, key: str, ts: str, size: str) -> DataFrame:
    return tumbling_agg(df, [key], ts, size, F.count(F.lit(1)).alias("n"))


def bounds_as_text(df: DataFrame, fmt: str = MICROS_UTC) -> DataFrame:
    return df.withColumns({c: bound_text(F.col(c), fmt) for c in ("window_start", "window_end")})
