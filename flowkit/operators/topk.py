"""The k largest per group with all ties, and means over them.

A rank over a whole group would carry every row tied at the k-th place to one
task. Here rows are first counted per distinct value. Of those each task keeps
at most k per group, so a group of any size brings k rows per task together,
and the k-th value follows from their counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowkit.functions.numbers import known
from flowkit.operators.joins import null_safe


def _leading(per_value: DataFrame, groups: list[str], value: str, count: str, k: int) -> DataFrame:
    """Rows of the values a group's k largest members have, ties included.

    ``per_value`` holds a value once per group and how many members have it.
    NULL comes last and is kept only while there are fewer than k members.
    """
    largest = Window.partitionBy(*groups).orderBy(F.col(value).desc_nulls_last())
    before = F.sum(count).over(largest.rowsBetween(Window.unboundedPreceding, -1))
    return (
        per_value.withColumn("__place", F.row_number().over(largest))
        .where(F.col("__place") <= k)
        .withColumn("__before", F.coalesce(before, F.lit(0)))
        .where(F.col("__before") < k)
        .drop("__place", "__before")
    )


def kth_value(df: DataFrame, groups: list[str], value: str, k: int) -> DataFrame:
    """The k-th largest value of each group, or its least if it has fewer."""
    per_value = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("__n"))
    return _leading(per_value, groups, value, "__n", k).groupBy(*groups).agg(F.min(value).alias("kth"))


def top_k_ties(df: DataFrame, groups: list[str], value: str, k: int) -> DataFrame:
    """Rows whose value is among the k largest of their group, ties included.

    Two pruned scans: one finds the k-th value per group, one keeps the rows
    that reach it.
    """
    limits = df.transform(kth_value, groups, value, k).toDF(*[f"__{g}" for g in groups], "__kth")
    on = null_safe(df, limits, [(g, f"__{g}") for g in groups])
    return df.join(limits, on).where(F.col(value) >= F.col("__kth")).select(*df.columns)


def top_hub_mean(
    df: DataFrame, groups: list[str], departure: str, arrival: str, values: list[str], k: int = 10
) -> DataFrame:
    """Mean of some columns over the rows that arrive at a group's busiest hubs.

    A hub counts its arrivals plus its departures and must have both; the
    busiest are the k largest counts with all ties. A group without such a hub
    keeps a row with NULL means. Rows with a NULL group drop out.

    Rows are aggregated per (group, hub) at once, then per (group, count):
    hubs of equal count are in or out together, so nothing is joined back.
    """
    named = df
    for name in groups:
        named = named.where(F.col(name).isNotNull())
    ends = F.array(
        F.struct(F.col(departure).alias("__hub"), F.lit(False).alias("__arrives")),
        F.struct(F.col(arrival).alias("__hub"), F.lit(True).alias("__arrives")),
    )
    hub, arrives, busy = F.col("__hub"), F.col("__arrives"), F.col("__busy")
    per_hub = (
        named.select(*groups, *[known(F.col(v)).alias(v) for v in values], F.inline(ends))
        .groupBy(*groups, "__hub")
        .agg(
            F.count(F.when(arrives, 1)).alias("__in"),
            F.count(F.when(~arrives, 1)).alias("__out"),
            *[F.sum(F.when(arrives, F.col(v))).alias(f"__sum_{v}") for v in values],
            *[F.count(F.when(arrives, F.col(v))).alias(f"__n_{v}") for v in values],
        )
    )
    both_ways = hub.isNotNull() & (F.col("__in") > 0) & (F.col("__out") > 0)
    per_count = (
        per_hub.withColumn("__busy", F.when(both_ways, F.col("__in") + F.col("__out")))
        .groupBy(*groups, "__busy")
        .agg(
            F.count(F.lit(1)).alias("__hubs"),
            *[F.sum(f"__sum_{v}").alias(f"__sum_{v}") for v in values],
            *[F.sum(f"__n_{v}").alias(f"__n_{v}") for v in values],
        )
    )

    def mean(v: str) -> Column:
        rows = F.sum(F.when(busy.isNotNull(), F.col(f"__n_{v}")))
        return F.try_divide(F.sum(F.when(busy.isNotNull(), F.col(f"__sum_{v}"))), rows).alias(v)

    return _leading(per_count, groups, "__busy", "__hubs", k).groupBy(*groups).agg(*[mean(v) for v in values])
