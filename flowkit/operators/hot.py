"""Frequent keys: found by a summary of bounded size, and spread before they are joined."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowkit.session import materialize

#: Keys that a task adds up before it reduces its summary.
_BUFFER = 1 << 20


def merged(keys: np.ndarray, counts: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray]:
    """A Misra-Gries summary of weighted keys: at most ``counters`` of them, with counts that are never too high.

    What the first key left out counts is taken from all. Summaries put one
    behind the other are merged the same way, and no count is too low by more
    than a share of ``1 / (counters + 1)`` of all the weight.
    """
    distinct, at = np.unique(keys, return_inverse=True)
    totals = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)
    if len(distinct) > counters:
        totals = totals - np.partition(totals, len(totals) - counters - 1)[len(totals) - counters - 1]
    keep = totals > 0
    return distinct[keep], totals[keep]


def _summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size, total = [], [], 0, 0
        for batch in batches:
            own = batch.column(0).to_numpy()
            keys.append(own)
            counts.append(np.ones(len(own), np.int64))
            size, total = size + len(own), total + len(own)
            if size >= max(_BUFFER, 2 * counters):
                few = merged(np.concatenate(keys), np.concatenate(counts), counters)
                keys, counts, size = [few[0]], [few[1]], len(few[0])
        if not total:
            return
        found, weights = merged(np.concatenate(keys), np.concatenate(counts), counters)
        yield pa.RecordBatch.from_pydict({"hash": found, "n": weights, "total": np.zeros(len(found), np.int64)})
        yield pa.RecordBatch.from_pydict({"hash": np.zeros(1, np.int64), "n": np.zeros(1, np.int64), "total": [total]})

    return run


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_hashes(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Hashes ``hash`` of all keys that at least ``share`` of the rows have, with the ``part`` of the rows they have at least.

    Some that half as many rows have may come too, so there are at most
    ``2 / share``. Each task sums up the hashes it reads in ``2 / share``
    counters (Misra and Gries), and only those are shuffled and added.
    """
    counters = math.ceil(2 / share)
    sums = (
        df.select(_hash(keys).alias("hash"))
        .mapInArrow(_summaries(counters), "hash long, n long, total long")
        .groupBy("hash")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    sums = materialize(sums, "summaries")
    total = sums.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    least = share * total - total / (counters + 1)
    enough = (F.col("n") > 0) & (F.col("n") >= F.lit(least))
    return sums.where(enough).select("hash", (F.col("n") / F.lit(max(1, total))).alias("part"))


def heavy_hitters(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """The keys that at least ``share`` of the rows have, with their exact numbers ``n``; NULL is a key like any other.

    Two passes: the first finds the few keys that can be frequent, the second
    counts those. No other key is shuffled.
    """
    found = hot_hashes(df, keys, share).select("hash")
    total = df.agg(F.count(F.lit(1)).alias("total"))
    # At most 2 / share rows.
    counted = (
        df.select(*keys)
        .join(F.broadcast(found), _hash(keys) == F.col("hash"), "left_semi")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.where(F.col("n") >= F.ceil(total.scalar() * F.lit(share)))


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    fact_keys: Sequence[str],
    lookup_keys: Sequence[str],
    how: str = "left",
    share: float | None = None,
    broadcast_small: bool = True,
) -> DataFrame:
    """Facts with the columns of ``lookup`` (but its keys) at equal keys, frequent keys spread over many tasks.

    An unmatched fact keeps NULLs (``how="left"``); a key found twice in the
    lookup doubles its facts; NULL matches nothing. Reads the keys of the
    facts when called. Facts whose key at least ``share`` of the rows have
    (by default half of an even partition) are cut into parts by a hash of
    the row, in proportion to their number, and only the lookup rows of such
    keys are copied, one for each part: at most ten times as many copies as
    there are partitions. All other rows are joined as they are. Rows equal in all
    columns stay together. A lookup that Spark knows to be small enough to
    broadcast is joined without any of this, unless ``broadcast_small`` is off.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    spark = facts.sparkSession
    names = [f"__key{i}" for i in range(len(lookup_keys))]
    right = lookup.withColumnsRenamed(dict(zip(lookup_keys, names)))
    equal = [F.col(f) == F.col(n) for f, n in zip(fact_keys, names)]
    if broadcast_small and _fits(lookup):
        return facts.join(right, equal, how).drop(*names)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_hashes(facts, fact_keys, share or 1 / (2 * partitions))
    # Each part is a quarter of an even partition. At most 2 / share rows.
    parts = F.ceil(F.col("part") * 4 * partitions).cast("int").alias("__parts")
    hot = F.broadcast(hot.select(F.col("hash").alias("__hash"), parts))
    columns = facts.columns
    salt = F.when(F.col("__parts").isNotNull(), F.pmod(F.xxhash64(*columns), F.col("__parts")).cast("int")).otherwise(0)
    left = facts.join(hot, _hash(fact_keys) == F.col("__hash"), "left").withColumn("__salt", salt)
    copies = F.sequence(F.lit(0), F.coalesce(F.col("__parts"), F.lit(1)) - 1)
    right = right.join(hot, _hash(names) == F.col("__hash"), "left").withColumn("__copy", F.explode(copies))
    # Made in the plan, the copies look small to Spark; the hint keeps it from broadcasting them.
    right = right.drop("__hash", "__parts").hint("merge")
    kept = [F.col(f"`{c}`") for c in (*columns, *(c for c in lookup.columns if c not in lookup_keys))]
    return left.join(right, [*equal, F.col("__salt") == F.col("__copy")], how).select(*kept)


def _fits(df: DataFrame) -> bool:
    """Whether Spark knows the frame to be small enough to broadcast."""
    session = df.sparkSession._jsparkSession.sessionState()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= int(session.conf().autoBroadcastJoinThreshold())
