"""Hard negatives against a plain version, and the residue arithmetic alone."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowkit.llm.negatives import Residues, mine_negatives, moduli

SCHEMA = "vec_id long, label int, embedding array<float>"


def plain(rows, every=50, positives=5, negatives=3, low=50, high=95):
    own = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in v]
        if sum((abs(x) + 1) ** 2 for x in whole) < 2**56:
            own[i] = min(own.get(i, (label, whole)), (label, whole))
    out = set()
    for a, (label, v) in own.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, (m, w) in own.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [(t, n) for t, n, m in scored if m != label and low * -s <= 100 * -t <= high * -s][:negatives]
            out |= {(a, p, k, n, -s, -t) for k, (t, n) in enumerate(fits, 1)}
    return out


def found(frame):
    rows = frame.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    got = {tuple(r) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("block_values", [1 << 22, 300])
@pytest.mark.parametrize("values", [(-1.0, 1.0), (0.0, 0.01)])
def test_mining_is_the_plain_version(spark, block_values, values):
    r = random.Random(block_values)
    rows = [
        (i, r.randint(0, 2) if i % 3 else 0, [r.uniform(*values) for _ in range(6)]) for i in r.sample(range(-300, 700), 400)
    ]
    got = found(mine_negatives(spark.createDataFrame(rows, SCHEMA), every=10, block_values=block_values))
    assert got == plain(rows, every=10) and got


def test_ties_and_repeats(spark):
    rows = [(i, i % 2, [1.0, 0.5]) for i in range(40)] + [(i, i % 2, [0.8, 0.4]) for i in range(40, 60)]
    rows += [(10, 1, [1.0, 0.5]), (10, 0, [1.0, 0.5]), (10, 0, [0.25, 0.5]), (50, 0, [0.8, 0.4])]
    got = found(mine_negatives(spark.createDataFrame(rows, SCHEMA), every=10))
    assert got == plain(rows, every=10) and got


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 2, [0.5, 0.5]), (3, 2, [0.6]), (4, 2, []), (5, 1, [0.2, 0.1, 9.0])]
    rows += [(6, None, [1.0]), (7, 2, None), (8, 2, [0.7, None]), (9, 2, [nan, 0.5]), (None, 2, [0.9, 0.5]), (11, 2, [inf])]
    rows += [(12, 2, [-inf, 0.1]), (50, None, [1.0]), (100, 3, []), (150, 2, [3e38, 1.0]), (13, 2, [3e38, 1.0])]
    docs = spark.createDataFrame(rows, SCHEMA)
    extra = docs.select("*", *[F.lit(n).alias(n) for n in ("vector", "i", "j", "norm", "rank", "score", "anchor_id")])
    assert found(mine_negatives(extra)) == plain(rows)
    assert found(mine_negatives(extra.withColumn("embedding", F.col("embedding").cast("array<double>")))) == plain(rows)
    for none in (docs.limit(0), docs.where("vec_id > 5")):
        assert mine_negatives(none).collect() == []


@pytest.mark.parametrize("inner, size", [(1, 1000), (64, 4000), (768, 100_000), (2100, 3_000_000)])
def test_products_are_exact(inner, size):
    r = np.random.default_rng(inner)
    a, b = r.integers(-size, size + 1, (7, inner)), r.integers(-size, size + 1, (9, inner))
    a[0], b[0], b[1] = size, size, -size
    primes = moduli(float(inner * size**2), min(inner, 1024))
    got = Residues(a.astype(float), primes).times(Residues(b.astype(float), primes), slice(0, 7), slice(2, 9))
    assert (got == a @ b[2:].T).all()
    whole = Residues(a.astype(float), primes).times(Residues(b.astype(float), primes), slice(0, 1), slice(0, 2))
    assert whole.tolist() == [[inner * size**2, -inner * size**2]]


def test_moduli_keep_float32_exact():
    for inner in (1, 64, 1024):
        primes = moduli(2.0**56, inner)
        assert all(inner * ((p - 1) // 2) ** 2 < 2**24 for p in primes)
        assert len(set(primes)) == len(primes) and math.prod(primes) > 2**57
