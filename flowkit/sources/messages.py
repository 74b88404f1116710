"""Unbounded sources: messages with a binary value and an event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.functions.times import attribute_time

MESSAGE_SCHEMA = "value binary, ts timestamp"


def read_messages(
    spark: SparkSession,
    path: str | None = None,
    topic: str | None = None,
    servers: str | None = None,
    files_per_batch: int | None = None,
    starting_offsets: str = "latest",
    time_attribute: str | None = None,
) -> DataFrame:
    """A stream of ``value`` and ``ts`` from either a folder or a Kafka topic.

    ``path`` is a folder of parquet files with those two columns, picked up in
    the order of their age. ``topic`` needs the Kafka connector on the class
    path; ``ts`` is the record timestamp, or the header ``time_attribute`` names.
    """
    if (path is None) == (topic is None):
        raise ValueError("give exactly one of path and topic")
    if path is not None:
        reader = spark.readStream.schema(MESSAGE_SCHEMA)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(path)
    if not servers:
        raise ValueError("a topic needs its servers")
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("includeHeaders", time_attribute is not None)
        .load()
    )
    return records.select("value", record_time(time_attribute).alias("ts"))


def record_time(attribute: str | None = None) -> Column:
    """Time of a Kafka record: its timestamp, or the last header of that name."""
    if attribute is None:
        return F.col("timestamp")
    named = F.filter("headers", lambda h: h["key"] == attribute)
    return attribute_time(F.try_element_at(named, F.lit(-1))["value"].cast("string"))
