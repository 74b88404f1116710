"""Feed a table to a stream in time order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowkit.session import scratch_dir


def time_slices(df: DataFrame, ts: str, parts: int) -> list[DataFrame]:
    """Cut a table into ``parts`` spans of equal length in time."""
    when = F.col(ts).cast("timestamp")
    low, high = df.agg(F.min(F.unix_micros(when)), F.max(F.unix_micros(when))).first()
    if low is None:
        return []
    cuts = [F.timestamp_micros(F.lit(low + (high - low) * i // parts)) for i in range(1, parts)]
    after = [df, *[df.where(when >= cut) for cut in cuts]]
    return [*[part.where(when < cut) for part, cut in zip(after, cuts)], after[-1]]


def replay(
    slices: Sequence[DataFrame],
    open_stream: Callable[[str], DataFrame],
    start: Callable[[DataFrame, str, str], StreamingQuery],
) -> str:
    """Write each slice to a source folder and run the stream after it.

    ``open_stream`` turns the source folder into a stream, ``start`` starts it
    into an output folder with a checkpoint folder. Each run is a restart from
    that checkpoint. All files of a slice make one micro-batch, so it does not
    matter how many tasks wrote them. Returns the output folder.
    """
    spark = slices[0].sparkSession
    source, target, checkpoint = (scratch_dir(spark, f"stream-{x}") for x in ("in", "out", "state"))
    for part in slices:
        part.write.mode("append").parquet(source)
        start(open_stream(source), target, checkpoint).awaitTermination()
    return target
