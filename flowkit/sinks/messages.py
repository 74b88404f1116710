"""Streaming sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_append(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = False, every: str | None = None
) -> StreamingQuery:
    """Append a stream to a parquet folder, exactly once per checkpoint.

    ``available_now`` works off what has arrived and stops; a later start with
    the same checkpoint goes on from there. ``every`` is the processing
    interval of a stream that keeps running.
    """
    writer = df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start(path)


def start_publish(
    df: DataFrame,
    value: Column,
    checkpoint: str,
    path: str | None = None,
    topic: str | None = None,
    servers: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Publish one binary ``value`` per row to a folder or a Kafka topic."""
    if (path is None) == (topic is None):
        raise ValueError("give exactly one of path and topic")
    messages = df.select(value.cast("binary").alias("value"))
    if path is not None:
        return start_append(messages, path, checkpoint, available_now)
    if not servers:
        raise ValueError("a topic needs its servers")
    writer = (
        messages.writeStream.outputMode("append")
        .format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
