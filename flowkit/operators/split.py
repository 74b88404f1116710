"""Several outputs from one input, and their union."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowkit.functions import text
from flowkit.functions.numbers import known
from flowkit.operators.counting import total

# Names of the outputs of the word split.
LONG, SHORT, CHARS = "words", "short_words", "chars"


def word_stats(df: DataFrame, column: str = "value") -> DataFrame:
    """Counts per word, and the characters of the lines that begin with it.

    A line without words counts for the NULL word. One scan and one shuffle
    give all that the three outputs need.
    """
    line = F.col(column)
    return (
        df.where(line.isNotNull())
        .select(
            F.length(line).alias("size"),
            F.posexplode_outer(text.words(line, text.ASCII_WORD)).alias("pos", "word"),
        )
        .groupBy("word")
        .agg(
            F.count("word").alias("n"),
            F.sum(F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.col("size"))).alias("chars"),
        )
    )


def split_words(stats: DataFrame) -> dict[str, DataFrame]:
    """Long words and short words with their counts, and the number of characters.

    ``stats`` comes from ``word_stats``; materialize it first if more than one
    output is used. Without a line ``chars`` has no row.
    """
    words = stats.where(F.col("word").isNotNull()).select("word", "n")
    return {
        LONG: words.where(~text.is_short(F.col("word"))),
        SHORT: words.where(text.is_short(F.col("word"))),
        CHARS: stats.transform(total, F.col("chars"), CHARS),
    }


def with_route(df: DataFrame, conditions: Mapping[str, Column], route: str = "route") -> DataFrame:
    """Name of the first condition a row meets, NULL if it meets none."""
    chosen = None
    for name, condition in conditions.items():
        chosen = F.when(condition, name) if chosen is None else chosen.when(condition, name)
    if chosen is None:
        raise ValueError("no condition given")
    return df.withColumn(route, chosen)


def partition_rows(df: DataFrame, conditions: Mapping[str, Column]) -> dict[str, DataFrame]:
    """Each row in exactly one of the named frames, or in none."""
    routed = df.transform(with_route, conditions, "__route")
    return {name: routed.where(F.col("__route") == name).drop("__route") for name in conditions}


def all_present(columns: list[str]) -> Column:
    """True where no column is NULL or NaN."""
    return reduce(lambda a, b: a & b, [known(F.col(c)).isNotNull() for c in columns])


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, duplicates kept, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
