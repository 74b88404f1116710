"""Quality learned from pairs: held-out accuracy, the model alone, odd rows."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowkit.llm import ranking
from flowkit.llm.catalog import QUERIES
from flowkit.llm.ranking import FEATURES, features, fit, fit_table, score_quality, table, train_ranker
from tests.llm.helpers import clashing, frame

FOLDER = "/root/testdata/sf0.01"
GOOD = "The rain had stopped before noon, and people came out to see what was left of the market."
BAD = "### $$$ &&& buy%%% now*** | | | buy%%% now***"
LABELS = "doc_id long, quality int, toxic int"


def corpus(n):
    r = np.random.default_rng(3)
    words = [GOOD.split(), BAD.split()]
    rows = [(i, " ".join(r.permutation(words[i % 2]).tolist()[: r.integers(5, 15)])) for i in range(n)]
    return rows, [(i, 1 - i % 2, 0) for i in range(n)]


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op13_quality_ranking"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality IS NOT NULL").collect()
    out = [(got[x.doc_id], x.quality) for x in labels if x.doc_id in got and got[x.doc_id].held_out]
    assert len(out) > 50 and np.mean([r.predicted == q for r, q in out]) >= 0.95
    ranked = [(a.score > b.score) + 0.5 * (a.score == b.score) for a, p in out for b, q in out if p > q]
    assert np.mean(ranked) >= 0.97


def test_scores_follow_from_the_text_alone(spark):
    rows, marks = corpus(300)
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, LABELS)
    model = train_ranker(docs, labels)
    want = {i: s for (i, _), s in zip(rows, model.score(table([t.encode() for _, t in rows])))}
    got = score_quality(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy")), labels).collect()
    assert all(abs(r.score - want[r.doc_id]) < 1e-12 for r in got)
    assert np.mean([r.predicted == 1 - r.doc_id % 2 for r in got]) == 1
    # The labels of held out documents teach nothing.
    other = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in marks]
    assert np.allclose(train_ranker(docs, spark.createDataFrame(other, LABELS)).weights, model.weights)


def test_bounded_samples(spark):
    rows, marks = corpus(300)
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, LABELS)
    some = score_quality(docs, labels, sample=20).collect()
    assert np.mean([r.predicted == 1 - r.doc_id % 2 for r in some]) >= 0.97
    assert not np.allclose(train_ranker(docs, labels, sample=20).weights, train_ranker(docs, labels).weights)


def test_odd_rows(spark):
    rows, marks = corpus(60)
    odd = [(1000, None), (1001, ""), (None, GOOD), (None, None), (0, GOOD), (0, GOOD), (1002, " \n\t"), (1003, GOOD * 4000), (1004, "é\0")]
    marks += [(None, 1, 0), (0, 0, 0), (1, None, None), (2, 7, 0), (5000, 1, 0), (1000, 0, 0), (1000, 0, 0)]
    docs = clashing(frame(spark, rows + odd)).withColumn("label", F.lit("x")).withColumn("hash", F.lit(1)).withColumn("score", F.lit(2))
    labels = spark.createDataFrame(marks, LABELS).withColumn("body", F.lit("x"))
    got = score_quality(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(i) for i, _ in rows + odd)
    assert all(r.score is not None and r.held_out is not None for r in got.collect())
    assert len({r.score for r in got.where("doc_id IN (1000, 1001)").collect()}) == 1
    assert score_quality(docs.limit(0), labels).count() == 0
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert {(r.score, r.predicted) for r in score_quality(docs, none).collect()} == {(0.5, 1)}


def test_the_model_minimises_the_loss_on_pairs():
    r = np.random.default_rng(5)
    rows = r.normal(size=(400, FEATURES))
    labels = (rows[:, 0] + 0.5 * rows[:, 1] + r.normal(size=400) > 0.8).astype(int)
    model = fit(rows, labels, pairs=4)
    plain = (rows - rows.mean(0)) / rows.std(0)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    random, size = np.random.default_rng(11), max(len(good), len(bad))
    first = np.concatenate([np.resize(random.permutation(good), size) for _ in range(4)])
    second = np.concatenate([np.resize(random.permutation(bad), size) for _ in range(4)])

    def loss(w):
        d = (plain[first] - plain[second]) @ w
        return np.log1p(np.exp(-d)).sum() + 0.5 * 1e-4 * len(first) * w @ w

    best = loss(model.weights)
    assert all(loss(model.weights + 0.01 * r.normal(size=FEATURES)) > best for _ in range(50))
    assert ((model.strength(rows) < model.threshold).sum()) == len(bad)
    assert (model.score(rows) >= 0.5).sum() == len(good)


def labelled(spark, rows, labels):
    values = [(int(l), i, r.tolist()) for i, (r, l) in enumerate(zip(rows, labels))]
    return spark.createDataFrame(values, "label int, hash long, features array<double>")


def test_one_block_is_the_model_of_an_array(spark):
    r = np.random.default_rng(7)
    rows = r.normal(size=(300, FEATURES))
    labels = (rows[:, 0] + r.normal(size=300) > 0.8).astype(int)
    want, got = fit(rows, labels), fit_table(labelled(spark, rows, labels))
    assert np.allclose(got.weights, want.weights, atol=1e-9) and abs(got.threshold - want.threshold) < 1e-9


@pytest.mark.parametrize("rare", [0.002, 0.1, 0.5])
def test_every_labelled_row_teaches(spark, monkeypatch, rare):
    monkeypatch.setattr(ranking, "BLOCK", 64)
    monkeypatch.setattr(ranking, "LEAST", 16)
    r = np.random.default_rng(9)
    rows = r.normal(size=(1000, FEATURES))
    good = np.argsort(rows[:, 0] + 0.3 * r.normal(size=1000))[-int(1000 * rare) :]
    labels = np.isin(np.arange(1000), good).astype(int)
    frame = labelled(spark, rows, labels)
    model = fit_table(frame)
    assert np.allclose(model.mean, rows.mean(0)) and np.allclose(model.spread, rows.std(0))
    assert (model.score(rows) >= 0.5).sum() == len(good)
    assert np.corrcoef(model.strength(rows), fit(rows, labels).strength(rows))[0, 1] > 0.9
    ranked = frame.select("label", "features", "hash").withColumn(
        "rank", (F.row_number().over(Window.partitionBy("label").orderBy("hash")) - 1).cast("long")
    )
    counts = [1000 - len(good), len(good)]
    blocks = ranking._blocks(ranked, counts).collect()
    often = int(counts[1] > counts[0])
    assert sorted(b["rank"] for b in blocks if b.label == often) == list(range(max(counts)))
    assert {b["rank"] for b in blocks if b.label != often} == set(range(min(counts)))
    sizes = Counter((b.block, b.label) for b in blocks)
    assert len(sizes) == 2 * -(-max(counts) // 64)
    assert all(n <= 64 if k == often else n >= min(16, min(counts)) for (_, k), n in sizes.items())


def test_more_labels_than_a_former_sample(spark):
    # All that stand apart come after the 20,000 of least hash, which used to be all that was learned from.
    ids = spark.range(70_000).withColumn("hash", F.xxhash64("id")).where("crc32(cast(cast(id AS string) AS binary)) % 3 <> 1")
    order = ids.withColumn("odd", F.row_number().over(Window.orderBy("hash")) > 42_000)
    text = F.when(F.col("odd") & (F.col("id") % 2 == 1), F.lit("### $$$")).otherwise(F.lit("Rain, at noon."))
    docs = order.select(F.col("id").alias("doc_id"), text.alias("text"))
    labels = order.select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, 1).otherwise(0).alias("quality"))
    model = train_ranker(docs, labels)
    good, bad = model.strength(table([b"Rain, at noon.", b"### $$$"]))
    assert good > bad


@pytest.mark.parametrize("text", [b"", b" ", b"\n\n", b"a", b"a a a", "é".encode() * 10, b"\0" * 100])
def test_features_are_numbers(text):
    own = features(text)
    assert own.shape == (FEATURES,) and np.isfinite(own).all()
