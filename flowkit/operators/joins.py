"""Joins with lookup tables, member lists and single values.

None of these forces a broadcast. Catalyst broadcasts a side whose size it
knows to be under ``spark.sql.autoBroadcastJoinThreshold``; beyond that both
sides shuffle, and adaptive execution splits the partition of a hot key.
``salts`` spreads hot keys without adaptive execution.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowkit.functions.numbers import known


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    how: str = "left",
    salts: int = 1,
) -> DataFrame:
    """Facts with the columns of ``lookup`` (but its key) at equal keys.

    An unmatched fact keeps NULLs (``how="left"``); a key found twice in the
    lookup doubles its facts. With ``salts`` > 1 every lookup row is copied
    that often and every fact meets one copy, so the facts of one key go to
    ``salts`` tasks (rows equal in all columns stay together).
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    right = lookup.withColumnRenamed(lookup_key, "__key")
    on = F.col(fact_key) == F.col("__key")
    if salts > 1:
        # From the row itself, so that a task run again after a lost executor
        # sends each row to where it went before.
        facts = facts.withColumn("__salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int"))
        # Spark takes the copies for as small as the lookup; the hint keeps it from broadcasting them.
        right = right.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
        on = on & (F.col("__salt") == F.col("__copy"))
    return facts.join(right, on, how).drop("__key", "__salt", "__copy")


def lookup_sum(
    facts: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str, group: str, value: str
) -> DataFrame:
    """Sum of a fact column per group of the lookup; facts without one drop out.

    The facts are summed per key before the join: the join then sees one row
    per key, so neither the size of the facts nor a hot key reaches it. The
    sum of a key counts once per lookup row of that key, as its facts would.
    """
    per_key = (
        facts.where(F.col(fact_key).isNotNull())
        .groupBy(fact_key)
        .agg(F.coalesce(F.sum(known(F.col(value))), F.lit(0)).alias(value))
    )
    named = lookup.where(F.col(group).isNotNull()).select(F.col(lookup_key).alias("__key"), group)
    return (
        per_key.join(named, F.col(fact_key) == F.col("__key"))
        .groupBy(group)
        .agg(F.sum(value).alias(value))
    )


def keep_members(df: DataFrame, column: str, members: DataFrame, member: str) -> DataFrame:
    """Rows whose value occurs among the members, each once."""
    return df.join(members.select(F.col(member).alias("__member")), F.col(column) == F.col("__member"), "left_semi")


def aligned_count_sum(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of both frames per key, for keys that occur in both.

    One shuffle: the frames are tagged, put together and counted at once.
    """
    tagged = left.select(key, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        right.select(key, F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    return (
        tagged.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        .where("a > 0 AND b > 0")
        .select(key, (F.col("a") + F.col("b")).alias("n"))
    )


def single_value(one_row: DataFrame, column: str) -> Column:
    """The value of a one-row frame as a column for any other frame.

    Spark runs the small frame first and puts its value into the plan. It
    raises when the frame has no row or more than one.
    """
    found = one_row.agg(F.count(F.lit(1)).alias("rows"), F.first(column).alias("value"))
    return found.select(
        F.when(F.col("rows") == 1, F.col("value")).otherwise(
            F.raise_error(F.concat(F.lit("expected one row, got "), F.col("rows").cast("string")))
        )
    ).scalar()


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Equality of column pairs that lets NULL match NULL."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])
