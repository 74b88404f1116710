"""Quality of texts, learned from pairs of which one is preferred."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowkit.session import materialize

#: Documents of the more frequent label in a block, and of the other one at least, if there are as many.
BLOCK, LEAST = 8_192, 1_024
#: Pairs that each document of the more frequent label is put into.
PAIRS = 8
#: Weight of the squared weights in the loss, as a share of the pairs.
PENALTY = 1e-4

_BYTES = np.arange(256)


def _class(members: bytes) -> np.ndarray:
    return np.isin(_BYTES, np.frombuffer(members, np.uint8))


#: Classes of bytes whose shares are features.
_CLASSES = np.stack(
    [
        (_BYTES >= 65) & (_BYTES <= 90),
        (_BYTES >= 97) & (_BYTES <= 122),
        (_BYTES >= 48) & (_BYTES <= 57),
        _class(b"#*$%&|<>"),
        _class(b"!"),
        _class(b".,;:?"),
        _class(b"/\\@=_{}[]()+~^`\"'-"),
        _class(b" "),
        _class(b"\t\n\x0b\x0c\r"),
        _BYTES >= 128,
    ],
    axis=1,
).astype(np.float64)
FEATURES = 2 * _CLASSES.shape[1] + 7


def features(text: bytes) -> np.ndarray:
    """What a text looks like: shares of kinds of bytes, and how much its words and lines repeat. All zero if empty."""
    out = np.zeros(FEATURES)
    if not text:
        return out
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES / len(text)
    k = len(shares)
    out[:k], out[k : 2 * k] = shares, np.sqrt(shares)
    words, lines = text.split(), text.split(b"\n")
    n, distinct = len(words), len(set(words))
    if n:
        again = sum(map(operator.eq, words, islice(words, 1, None)))
        out[2 * k :] = [
            np.log1p(n),
            np.log1p(len(text) / n),
            distinct / n,
            np.log1p(distinct) / np.log1p(n),
            again / n,
            1 - len(set(lines)) / len(lines),
            np.log1p(len(lines) / n),
        ]
    return out


def table(texts: list[bytes]) -> np.ndarray:
    return np.stack([features(t) for t in texts]) if texts else np.empty((0, FEATURES))


@dataclass
class Ranker:
    """Scores documents by a weighted sum of standardised features; see ``fit``."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def plain(self, rows: np.ndarray) -> np.ndarray:
        # Texts unlike any that was learned from are taken for the outermost of them.
        return np.clip((rows - self.mean) / self.spread, -8, 8)

    def strength(self, rows: np.ndarray) -> np.ndarray:
        return self.plain(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The chance that a document is preferred to one that stands at the threshold."""
        return 1 / (1 + np.exp(-np.clip(self.strength(rows) - self.threshold, -30, 30)))


def _differences(plain: np.ndarray, labels: np.ndarray, pairs: int, seed: int) -> np.ndarray:
    """Of pairs of a document of label 1 and one of label 0; each of the more frequent label is in ``pairs`` of them."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    random, size = np.random.default_rng(seed), max(len(good), len(bad))
    preferred = np.concatenate([np.resize(random.permutation(good), size) for _ in range(pairs)])
    other = np.concatenate([np.resize(random.permutation(bad), size) for _ in range(pairs)])
    return plain[preferred] - plain[other]


def _loss(differences: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How many pairs there are, then slope and curve of their logistic loss, in one row of numbers that add up."""
    wrong = 1 / (1 + np.exp(np.clip(differences @ weights, -30, 30)))
    slope = -(differences.T @ wrong)
    curve = (differences * (wrong * (1 - wrong))[:, None]).T @ differences
    return np.concatenate([[len(differences)], slope, curve.ravel()])


def _minimise(size: int, loss: Callable[[np.ndarray], np.ndarray], penalty: float) -> np.ndarray:
    """The weights of least loss and penalty, by Newton steps; ``loss`` gives what ``_loss`` does, for all pairs."""
    weights = np.zeros(size)
    for _ in range(60):
        found = loss(weights)
        ridge = penalty * found[0]
        slope, curve = found[1 : size + 1] + ridge * weights, found[size + 1 :].reshape(size, size) + ridge * np.eye(size)
        move = np.linalg.solve(curve, slope)
        weights = weights - move * min(1.0, 2.0 / max(1e-12, np.abs(move).max()))
        if np.abs(move).max() < 1e-8:
            break
    return weights


def _untaught() -> Ranker:
    return Ranker(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0)


def _unweighted(mean: np.ndarray, spread: np.ndarray) -> Ranker:
    return Ranker(mean, np.where(spread > 1e-9, spread, 1.0), np.zeros(len(mean)), 0.0)


def fit(rows: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, penalty: float = PENALTY, seed: int = 11) -> Ranker:
    """A Bradley-Terry model: the chance that one document is preferred to another is logistic in their scores' difference.

    Pairs are a document of label 1 and one of label 0; each document of the
    more frequent label meets ``pairs`` others, drawn by the seed. Newton
    steps minimise the logistic loss on the differences of features. The
    threshold is the quantile of the scores that leaves as many documents
    below it as have label 0. Without both labels every text scores one half.
    """
    below = int((labels == 0).sum())
    if not below or not (labels == 1).any():
        return _untaught()
    model = _unweighted(rows.mean(0), rows.std(0))
    differences = _differences(model.plain(rows), labels, pairs, seed)
    model.weights = _minimise(rows.shape[1], lambda weights: _loss(differences, weights), penalty)
    order = np.sort(model.strength(rows))
    model.threshold = float((order[below - 1] + order[below]) / 2)
    return model


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``place``, the position of each row in that order over the whole table, from 0; written once."""
    # The id counts the rows of a task in its lower 33 bits, the tasks above them.
    held = materialize(rows.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "placed")
    task = F.shiftright("at", 33)
    counts = held.groupBy(task.alias("task")).count().orderBy("task").collect()
    starts = np.cumsum([0, *[r["count"] for r in counts]]).tolist()
    first = held.sparkSession.createDataFrame([(r.task, s) for r, s in zip(counts, starts)], "task long, first long")
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return held.join(F.broadcast(first), task == F.col("task")).select(*rows.columns, (F.col("first") + within).alias("place"))


def _blocks(ranked: DataFrame, counts: list[int]) -> DataFrame:
    """Rows of ``label``, ``rank`` (from 0, per label) and ``features``, dealt to blocks of both labels.

    Those of the more frequent label are in one block each, at most ``BLOCK``
    of them. Of the others, at least ``LEAST`` are in each block if there are
    as many, so one may be in several; each is in one at least. Small tables
    make one block, with every row once.
    """
    often = int(counts[1] > counts[0])
    most, fewer = counts[often], counts[1 - often]
    blocks = -(-most // BLOCK)
    # As decimals: the products may pass 64 bits.
    start = lambda number, times, per: F.expr(f"CAST({number} AS DECIMAL(20)) * {times} div {per}")
    many = ranked.where(F.col("label") == often).select(start("rank", blocks, most).alias("block"), "label", "rank", "features")
    share = max(-(-fewer // blocks), min(fewer, LEAST))
    asked = ranked.sparkSession.range(blocks).select(
        F.col("id").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(share - 1))).alias("step")
    )
    asked = asked.select("block", ((start("block", fewer, blocks) + F.col("step")) % fewer).alias("rank"))
    few = ranked.where(F.col("label") != often).join(asked, "rank").select("block", "label", "rank", "features")
    return many.unionByName(few)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, FEATURES)


def fit_table(found: DataFrame, pairs: int = PAIRS, penalty: float = PENALTY, seed: int = 11) -> Ranker:
    """The model that ``fit`` makes, of a table of ``label`` (0 or 1), ``hash`` and ``features`` of any length.

    Means, spreads and the threshold are those of all rows. Pairs are drawn
    within blocks of rows that follow each other by their hash (``_blocks``),
    and each row of the more frequent label is in ``pairs`` of them. Every
    Newton step is one pass over all pairs; the driver gets the sums of the
    tasks.
    """
    placed = _placed(found.select("label", "hash", "features"), "label", "hash", "features")
    values = [F.col("features")[i] for i in range(FEATURES)]
    counted = [F.count_if(F.col("label") == value) for value in (0, 1)]
    got = list(placed.agg(*counted, *map(F.avg, values), *map(F.stddev_pop, values)).first())
    counts = got[:2]
    if not all(counts):
        return _untaught()
    model = _unweighted(np.array(got[2 : 2 + FEATURES]), np.array(got[2 + FEATURES :]))
    rank = F.col("place") - F.when(F.col("label") == 1, counts[0]).otherwise(0)
    blocks = materialize(_blocks(placed.select("label", rank.alias("rank"), "features"), counts), "blocks")

    def loss(weights: np.ndarray) -> np.ndarray:
        def of_block(rows: pa.Table) -> pa.Table:
            labels, ranks = (rows.column(c).to_numpy() for c in ("label", "rank"))
            order, block = np.lexsort((ranks, labels)), rows.column("block")[0].as_py()
            plain = model.plain(_matrix(rows.column("features")))[order]
            return pa.table({"sums": [_loss(_differences(plain, labels[order], pairs, seed + block), weights)]})

        def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [np.sum(np.stack(b.column("sums").to_pylist()), axis=0) for b in batches if b.num_rows]
            if sums:
                yield pa.RecordBatch.from_pydict({"sums": [np.sum(sums, axis=0)]})

        schema = "sums array<double>"
        sums = blocks.groupBy("block").applyInArrow(of_block, schema).mapInArrow(of_task, schema)
        return np.sum([r.sums for r in sums.collect()], axis=0)

    model.weights = _minimise(FEATURES, loss, penalty)

    def strength(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array(model.strength(_matrix(batch.column("features"))))
            yield pa.RecordBatch.from_arrays([own, batch.column("place")], names=["strength", "of"])

    # Texts that are copies of each other are equally strong; their places part them.
    found = placed.select("features", "place").mapInArrow(strength, "strength double, of long")
    strengths = _placed(found, "strength", "of")
    middle = strengths.where(F.col("place").isin(counts[0] - 1, counts[0])).agg(F.avg("strength")).first()
    model.threshold = float(middle[0])
    return model


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: a third of them, by a checksum of the id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _plain(docs: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"))


def _featured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``features`` of each row, written once: the texts are read in one pass."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = table(batch.column("body").to_pylist())
            lists = pa.FixedSizeListArray.from_arrays(pa.array(own.ravel()), FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "features"])

    return materialize(_plain(docs).mapInArrow(rows, "doc_id long, features array<double>"), "features")


def _train(featured: DataFrame, labels: DataFrame, label: str, sample: int | None, pairs: int) -> Ranker:
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
    known = known.withColumn("hash", F.xxhash64("doc_id"))
    if sample is not None:
        least = [known.where(F.col("label") == value).orderBy("hash", "doc_id").limit(sample) for value in (0, 1)]
        known = least[0].unionByName(least[1])
    return fit_table(featured.join(known, "doc_id").select("label", "hash", "features"), pairs)


def train_ranker(
    docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int | None = None, pairs: int = PAIRS
) -> Ranker:
    """A model of what the label marks with 1, learned from all labelled documents that are not held out.

    With ``sample``, from at most that many rows of ``labels`` of each label,
    those with the least hash of their id.
    """
    return _train(_featured(docs), labels, label, sample, pairs)


def score_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int | None = None, pairs: int = PAIRS
) -> DataFrame:
    """The quality of each row of ``doc_id``, ``text``: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    The score, from 0 to 1, follows from the text alone, a NULL one counts as
    empty; ``predicted`` is 1 if it is one half or more. ``labels`` has
    ``doc_id`` and the label; rows whose label is neither 0 nor 1 teach
    nothing, several labels of a document all count. Rows with a NULL id are
    scored like any other and held out from nothing. See ``fit_table`` for the
    model, ``train_ranker`` for what it learns from and ``held_out`` for the
    documents that are never learned from. Texts are read once and not moved.
    """
    featured = _featured(docs)
    model = _train(featured, labels, label, sample, pairs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_matrix(batch.column("features")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    scored = featured.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
