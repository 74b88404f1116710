"""Counts, sums and distinct values.

Each is one aggregation: Spark sums within a task before it shuffles, so a
value that holds a third of all rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowkit.functions import text
from flowkit.functions.numbers import known


def explode_words(df: DataFrame, column: str = "value", pattern: str = text.UNICODE_WORD) -> DataFrame:
    """One row ``word`` per word of a text column."""
    return df.select(F.explode(text.words(F.col(column), pattern)).alias("word"))


def count_elements(df: DataFrame, column: str, factor: int = 1) -> DataFrame:
    """Rows per value times ``factor``, NULL included."""
    return df.groupBy(column).agg((F.count(F.lit(1)) * F.lit(factor)).alias("n"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL left out."""
    return df.where(F.col(column).isNotNull()).transform(count_elements, column)


def word_count(df: DataFrame, column: str = "value", pattern: str = text.UNICODE_WORD) -> DataFrame:
    return df.transform(explode_words, column, pattern).transform(count_elements, "word")


def format_counts(df: DataFrame, key: str = "word", count: str = "n") -> DataFrame:
    """One text row ``value`` per count, as ``key: count``."""
    return df.select(text.count_line(F.col(key), F.col(count)).alias("value"))


def keyed_sum(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sum per key; NULL keys drop out, a key without a known value sums to 0."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.coalesce(F.sum(known(F.col(value))), F.lit(0)).alias(value))
    )


def total(df: DataFrame, value: Column, name: str = "total") -> DataFrame:
    """Sum over all rows as one row; an empty input gives no row."""
    return df.agg(F.sum(value).alias(name), F.count(F.lit(1)).alias("rows")).where("rows > 0").select(name)
