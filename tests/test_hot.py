"""Frequent keys and joins that spread them."""

from collections import Counter
from contextlib import contextmanager

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowkit.operators import hot
from flowkit.operators.joins import lookup_join
from tests.conftest import rows


@contextmanager
def settings_of(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=60), max_size=5), st.integers(1, 6))
def test_a_summary_of_summaries_is_off_by_a_share(parts, counters):
    held = [hot.merged(np.array(p, np.int64), np.ones(len(p), np.int64), counters) for p in parts if p]
    if not held:
        return
    keys, counts = hot.merged(*(np.concatenate(x) for x in zip(*held)), counters)
    truth = Counter(k for p in parts for k in p)
    got = dict(zip(keys.tolist(), counts.tolist()))
    assert len(got) <= counters
    # Reduced twice: once in each part and once together.
    most = 2 * sum(truth.values()) / (counters + 1)
    assert all(truth[k] - most <= got.get(k, 0) <= truth[k] for k in truth)


def skewed(spark, n=60_000):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 1000)
    return spark.range(0, n, 1, 8).select(key.alias("k"), "id")


def test_heavy_hitters_are_exact(spark):
    facts = skewed(spark)
    counts = Counter(r.k for r in facts.collect())
    for share in (0.3, 0.05, 0.0009, 0.9):
        want = sorted(((k, n) for k, n in counts.items() if n >= share * 60_000), key=repr)
        assert rows(hot.heavy_hitters(facts, ["k"], share)) == want
    assert hot.heavy_hitters(facts.limit(0), ["k"], 0.1).collect() == []
    two = hot.heavy_hitters(facts.withColumn("m", F.col("k") % 2), ["k", "m"], 0.3)
    assert rows(two) == [(7, 1, counts[7])]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("small", [True, False])
def test_spread_join_equals_plain_join(spark, how, small):
    facts = skewed(spark, 6000)
    lookup = spark.createDataFrame([(7, "a"), (7, "b"), (2, "c"), (5, None), (None, "d")], "key bigint, name string")
    plain = lookup_join(facts, lookup, "k", "key", how)
    spread = hot.spread_join(facts, lookup, ["k"], ["key"], how, broadcast_small=small)
    assert spread.columns == plain.columns and rows(spread) == rows(plain)
    both = hot.spread_join(
        facts.withColumn("m", F.lit(1)), lookup.withColumn("n", F.lit(1)), ["k", "m"], ["key", "n"], how, broadcast_small=small
    )
    assert rows(both.drop("m")) == rows(plain)
    assert hot.spread_join(facts.limit(0), lookup, ["k"], ["key"], how, broadcast_small=small).count() == 0
    with pytest.raises(ValueError):
        hot.spread_join(facts, lookup, ["k"], ["key"], "full")


def test_a_third_on_one_key_is_spread_without_adaptive_execution(spark):
    lookup = spark.range(1000).select(F.col("id").alias("key"), F.col("id").cast("string").alias("name"))
    settled = {
        "spark__sql__adaptive__enabled": "false",
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__shuffle__partitions": "16",
    }
    with settings_of(spark, **settled):
        for join, even in (
            (lambda f: lookup_join(f, lookup, "k", "key"), False),
            (lambda f: hot.spread_join(f, lookup, ["k"], ["key"]), True),
        ):
            joined = join(skewed(spark))
            sizes = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
            assert sum(sizes) == 60_000
            assert (max(sizes) < 3 * np.median(sizes)) == even
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan


def test_only_rows_of_frequent_keys_are_copied(spark):
    facts, lookup = skewed(spark), spark.range(1000).select(F.col("id").alias("key"), F.col("id").alias("name"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = hot.hot_hashes(facts, ["k"], 1 / (2 * partitions)).collect()
    assert len(found) <= 4 * partitions and 0.3 < max(r.part for r in found) <= 0.34
    joined = hot.spread_join(facts, lookup, ["k"], ["key"], broadcast_small=False)
    assert joined.count() == 60_000 and joined.where("k IS NOT NULL AND name <> k").count() == 0
