"""Word counts, splits, counts of elements and text sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.catalog.registry import query, table
from flowkit.functions import text
from flowkit.operators import counting, split
from flowkit.session import materialize, scratch_dir
from flowkit.sinks.files import write_lines
from flowkit.sinks.shards import write_shards
from flowkit.sources import files as sources
from flowkit.sources.files import read_lines

_WORDS = r"SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}_'']+')) AS word FROM documents"
_ASCII_WORDS = "SELECT unnest(regexp_extract_all(text, '[A-Za-z'']+')) AS word FROM documents"
_LINES = "SELECT unnest(string_split(text, chr(10))) AS line FROM documents"


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("text")


def _document_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).select(F.explode(text.lines_of(F.col("text"))).alias("value"))


def _word_count(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).transform(counting.word_count, "text")


@query(f"SELECT word, count(*) AS n FROM ({_WORDS}) GROUP BY word")
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return _word_count(spark, folder)


@query(f"SELECT word || ': ' || count(*) AS value FROM ({_WORDS}) GROUP BY word")
def format_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _word_count(spark, folder).transform(counting.format_counts)


@query(f"""
    SELECT CASE WHEN length(word) <= 3 THEN 'short_words' ELSE 'words' END AS tag, word, count(*) AS n
    FROM ({_ASCII_WORDS}) GROUP BY ALL
    UNION ALL
    SELECT 'chars', NULL, sum(length(line))::BIGINT FROM ({_LINES})
""")
def split_short_long(spark: SparkSession, folder: str) -> DataFrame:
    stats = materialize(_document_lines(spark, folder).transform(split.word_stats), "split")
    frames = split.split_words(stats)
    chars = frames[split.CHARS].select(F.lit(None).cast("string").alias("word"), F.col(split.CHARS).alias("n"))
    parts = {**frames, split.CHARS: chars}
    return split.union_all(*[frame.withColumn("tag", F.lit(tag)) for tag, frame in parts.items()])


@query(f"SELECT sum(length(line))::BIGINT AS total FROM ({_LINES})")
def char_total(spark: SparkSession, folder: str) -> DataFrame:
    return _document_lines(spark, folder).transform(counting.total, F.length("value"))


@query(f"SELECT line AS value, count(*) AS n FROM ({_LINES}) GROUP BY line")
def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "lines")
    write_lines(_document_lines(spark, folder), path)
    return read_lines(spark, path).transform(counting.count_elements, "value")


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def count_elements(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").transform(counting.count_elements, "o_orderpriority")


@query("SELECT o_orderpriority, 2 * count(*) AS n FROM orders GROUP BY o_orderpriority")
def count_with_factor(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").transform(counting.count_elements, "o_orderpriority", factor=2)


@query("SELECT c_nationkey, count(*) AS n FROM customer WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey")
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").transform(counting.value_counts, "c_nationkey")


@query("""
    SELECT s_nationkey, coalesce(sum(round(s_acctbal * 100)::BIGINT), 0)::BIGINT AS cents
    FROM supplier WHERE s_nationkey IS NOT NULL GROUP BY s_nationkey
""")
def keyed_sum(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").withColumn("cents", F.round(F.col("s_acctbal") * 100).cast("bigint"))
    return suppliers.transform(counting.keyed_sum, "s_nationkey", "cents")


@query("SELECT DISTINCT source FROM documents")
def distinct_values(spark: SparkSession, folder: str) -> DataFrame:
    return sources.distinct_values(table(spark, folder, "documents"), "source")


@query(f"SELECT word || ': ' || count(*) AS value FROM ({_WORDS}) GROUP BY word")
def sink_roundtrip_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "word-lines")
    write_lines(_word_count(spark, folder).transform(counting.format_counts), path)
    return read_lines(spark, path)


@query("SELECT source || ': ' || count(*) AS value FROM documents GROUP BY source")
def sink_report(spark: SparkSession, folder: str) -> DataFrame:
    """A report of few lines, as a folder like any other output."""
    path = scratch_dir(spark, "source-lines")
    counts = table(spark, folder, "documents").transform(counting.count_elements, "source")
    write_lines(counts.transform(counting.format_counts, "source"), path)
    return read_lines(spark, path)


@query(f"SELECT word || ': ' || count(*) AS value FROM ({_WORDS}) GROUP BY word")
def sink_named_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Counts as lines in numbered shards, read back by their prefix."""
    prefix = f"{scratch_dir(spark, 'shards')}/counts"
    write_shards(_word_count(spark, folder).transform(counting.format_counts), prefix)
    return read_lines(spark, f"{prefix}-*-of-*")
