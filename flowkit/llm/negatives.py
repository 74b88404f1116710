"""Hard negatives by exact integer scores, multiplied in a residue number system."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowkit.session import materialize

#: Components of a block of rows or anchors, which bounds what a task holds.
BLOCK_VALUES = 1 << 22
#: Components of a block that small tables are still cut into, to keep all cores busy.
_LEAST_VALUES = 1 << 17
#: Anchors and rows whose scores are looked at together.
_ANCHORS, _ROWS = 256, 4096
#: Components that are summed in float32 before they are reduced.
_INNER = 1024
#: Integers up to this are exact in float32.
_EXACT = 1 << 24
#: Squared norms stay below, so that a hundred times a score fits a long.
_NORM = 2.0**56
_NONE = np.iinfo(np.int64).min


def moduli(bound: float, inner: int) -> list[int]:
    """The largest primes whose residues multiply exactly in float32, as many as tell apart all within ``bound``.

    A sum of ``inner`` products of balanced residues must stay below 2**24,
    and so must the product of a difference of digits with an inverse, which
    is worth four of them.
    """
    p = 2 * math.isqrt((_EXACT - 1) // max(4, inner)) + 1
    primes, product = [], 1
    while product <= 2 * bound + 1:
        if all(p % k for k in range(3, math.isqrt(p) + 1, 2)):
            primes.append(p)
            product *= p
        p -= 2
    return primes


def _balanced(values: np.ndarray, p: int) -> np.ndarray:
    """Residues between ``-p/2`` and ``p/2``, in place; the second turn mends what rounding got wrong by one."""
    for _ in range(2):
        values -= np.rint(values / values.dtype.type(p)) * values.dtype.type(p)
    return values


class Residues:
    """A matrix of integers as float32 matrices, one modulo each prime, in slices of the inner dimension."""

    def __init__(self, matrix: np.ndarray, primes: list[int]):
        self.primes = primes
        self.parts = [_balanced(matrix.copy(), p).astype(np.float32) for p in primes]

    def times(self, other: Residues, rows: slice, columns: slice) -> np.ndarray:
        """The exact product of some rows with the transpose of some rows of the other, by Chinese remainders.

        Mixed-radix digits are taken balanced, so the sum of digits times
        their radices is the signed product itself.
        """
        out, radix, digits = None, 1, []
        for k, p in enumerate(self.primes):
            a, b = self.parts[k][rows], other.parts[k][columns]
            digit = None
            for at in range(0, a.shape[1], _INNER):
                part = _balanced(a[:, at : at + _INNER] @ b[:, at : at + _INNER].T, p)
                digit = part if digit is None else _balanced(digit + part, p)
            if digit is None:
                digit = np.zeros((len(a), len(b)), np.float32)
            for earlier, q in zip(digits, self.primes):
                digit = _balanced((digit - earlier) * np.float32(_inverse(q, p)), p)
            digits.append(digit)
            scaled = digit.astype(np.int64) * radix
            out = scaled if out is None else out + scaled
            radix *= p
        return out


def _inverse(q: int, p: int) -> int:
    """The balanced inverse of ``q`` modulo ``p``."""
    x = pow(q, -1, p)
    return x - p if x > p // 2 else x


class _Vectors:
    """Rows of a group, one per id, in the order of their ids, as integers."""

    def __init__(self, table: pa.Table, scale: float, width: int):
        ids = table.column("vec_id").to_numpy()
        labels = table.column("label").to_numpy()
        lists = table.column("vector").combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.chunk(0) if lists.num_chunks else pa.array([], table.column("vector").type)
        sizes = np.diff(lists.offsets.to_numpy())
        values = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
        matrix = np.zeros((len(ids), width))
        at = np.repeat(np.arange(len(ids)), sizes)
        matrix[at, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
        order = np.argsort(ids, kind="stable")
        new = np.concatenate([[True], np.diff(ids[order]) != 0])[: len(ids)]
        if not new.all():
            # Rows that repeat an id count once: the one of the least label and vector.
            ends = np.append(np.flatnonzero(new)[1:], len(ids))
            groups = zip(np.flatnonzero(new).tolist(), ends.tolist())
            order = np.array([min(order[a:b], key=lambda i: (labels[i], matrix[i].tolist())) for a, b in groups])
        self.order, self.ids, self.labels, self.matrix = order, ids[order], labels[order], matrix[order]


def _first(group: np.ndarray, scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest scores of each group, ties by id."""
    order = np.lexsort((ids, -scores, group))
    sorted_group = group[order]
    start = np.flatnonzero(np.concatenate([[True], sorted_group[1:] != sorted_group[:-1]])[: len(order)])
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[rank < count]


def _tiles(anchors: int, rows: int):
    for a in range(0, anchors, _ANCHORS):
        for b in range(0, rows, _ROWS):
            yield slice(a, min(a + _ANCHORS, anchors)), slice(b, min(b + _ROWS, rows))


_POSITIVES = pa.schema([(n, pa.int64()) for n in ("anchor_id", "row_id", "score")])
_NEGATIVES = pa.schema(
    [(n, pa.int64()) for n in ("anchor_id", "positive_id", "positive_score", "row_id", "score")]
)


def _gathered(parts: list[tuple[np.ndarray, ...]], schema: pa.Schema) -> pa.Table:
    if not parts:
        return schema.empty_table()
    return pa.table([pa.array(np.concatenate(c)) for c in zip(*parts)], schema=schema)


def _best_of_label(scale: float, width: int, primes: list[int], count: int):
    """The best rows of an anchor's own label in one block of rows."""

    def work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return _POSITIVES.empty_table()
        r, a = _Vectors(rows, scale, width), _Vectors(anchors, scale, width)
        out = []
        for label in np.intersect1d(r.labels, a.labels):
            mine, theirs = np.flatnonzero(a.labels == label), np.flatnonzero(r.labels == label)
            left, right = Residues(a.matrix[mine], primes), Residues(r.matrix[theirs], primes)
            best = []
            for x, y in _tiles(len(mine), len(theirs)):
                scores = left.times(right, x, y)
                own, ids = a.ids[mine[x]], r.ids[theirs[y]]
                scores[own[:, None] == ids[None, :]] = _NONE
                if len(ids) > count:
                    least = np.partition(scores, len(ids) - count, axis=1)[:, len(ids) - count]
                    good = scores >= np.maximum(least, _NONE + 1)[:, None]
                else:
                    good = scores > _NONE
                i, j = np.nonzero(good)
                s = scores[i, j]
                keep = _first(i, s, ids[j], count)
                best.append((own[i[keep]], ids[j[keep]], s[keep]))
            own, ids, s = (np.concatenate(c) for c in zip(*best))
            keep = _first(own, s, ids, count)
            out.append((own[keep], ids[keep], s[keep]))
        return _gathered(out, _POSITIVES)

    return work


def _best_in_windows(scale: float, width: int, primes: list[int], positives: int, count: int, low: int, high: int):
    """For each anchor and positive, the best rows of another label within the window of scores, in one block."""

    def work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return _NEGATIVES.empty_table()
        r, a = _Vectors(rows, scale, width), _Vectors(anchors, scale, width)
        lists = anchors.column("positives").to_pylist()
        lists = [lists[i] for i in a.order]
        theirs = np.full((len(lists), positives), _NONE)
        least, most = np.ones((len(lists), positives), np.int64), np.zeros((len(lists), positives), np.int64)
        scores_of = np.zeros((len(lists), positives), np.int64)
        for n, own in enumerate(lists):
            for k, p in enumerate(own):
                theirs[n, k], s = p["row_id"], p["score"]
                scores_of[n, k], least[n, k], most[n, k] = s, -(-low * s // 100), high * s // 100
        left, right = Residues(a.matrix, primes), Residues(r.matrix, primes)
        some = least <= most
        floor = np.where(some, least, np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
        ceiling = np.where(some, most, _NONE).max(1, initial=_NONE)
        out = []
        for x, y in _tiles(len(a.ids), len(r.ids)):
            scores = left.times(right, x, y)
            good = (scores >= floor[x][:, None]) & (scores <= ceiling[x][:, None])
            good &= a.labels[x][:, None] != r.labels[y][None, :]
            i, j = np.nonzero(good)
            s, i = scores[i, j], i + x.start
            ids = r.ids[y][j]
            for k in range(positives):
                inside = (s >= least[i, k]) & (s <= most[i, k])
                n, own, found = i[inside], s[inside], ids[inside]
                keep = _first(n, own, found, count)
                n = n[keep]
                out.append((a.ids[n], theirs[n, k], scores_of[n, k], found[keep], own[keep]))
        return _gathered(out, _NEGATIVES)

    return work


def _ranked(rows: DataFrame, group: list[str], count: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "row_id")
    return rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= count)


def mine_negatives(
    vectors: DataFrame,
    vector: str = "embedding",
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """Hard negatives of each anchor and positive: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and scores.

    ``vectors`` has ``vec_id``, ``label`` and an array of numbers; other
    columns are left out. A component ``x`` counts as ``floor(scale * x)``,
    and a score is the exact inner product of two rows; higher ones come
    first, ties by the smaller id. Anchors are the rows whose id is divisible
    by ``every``, their positives the first rows of the same label, and the
    negatives of a positive the first rows of other labels whose score is
    between ``low`` and ``high`` hundredths of the positive's.

    A row with a NULL id, label or vector, or a component that is NULL or not
    finite, takes no part, and neither does one whose squared norm reaches
    2**56, as its scores would leave a long. Missing components of shorter
    vectors count as zero. Rows that repeat an id count as one row, the one
    of the least label, then the least components.

    Anchors and rows are dealt into blocks by their ids, and a task multiplies
    one block of anchors with one of rows: modulo several primes in float32,
    where every sum is exact, put together by Chinese remainders. A label of
    any size is spread over all blocks. Only the best of each block leave it.
    """
    components = F.col(f"`{vector}`")
    if dict(vectors.dtypes)[vector] != "array<float>":
        components = components.cast("array<double>")
    plain = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), components.alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    norm = F.aggregate(
        "vector", F.lit(0.0), lambda acc, x: acc + F.pow(F.abs(x.cast("double")) * scale + 1, F.lit(2.0))
    )
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite
    plain = plain.where(fit).withColumn("norm", norm).where(F.col("norm") < _NORM)
    # Also the pmod of a negative id is zero where it is divisible.
    anchor = F.pmod("vec_id", F.lit(every)) == 0
    width, values, top, mine = plain.agg(
        F.max(F.size("vector")), F.sum(F.size("vector")), F.max("norm"), F.sum(F.when(anchor, F.size("vector")))
    ).first()
    width, values, mine = width or 0, values or 0, mine or 0
    primes = moduli(top or 0, min(width, _INNER))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    row_blocks = max(1, -(-values // block_values), min(-(-values // _LEAST_VALUES), 2 * cores))
    anchor_blocks = max(1, -(-mine // block_values))
    plain = plain.drop("norm")

    def numbers(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    at = F.pmod(F.xxhash64("vec_id"), F.lit(row_blocks)).cast("int")
    rows = plain.withColumn("j", at).withColumn("i", numbers(anchor_blocks)).groupBy("i", "j")
    own = F.pmod(F.xxhash64("vec_id"), F.lit(anchor_blocks)).cast("int")
    # New names for the columns: both sides of the cogroups come from one frame.
    anchors = plain.where(anchor).withColumn("i", own).toDF("vec_id", "label", "vector", "i")
    near = rows.cogroup(anchors.withColumn("j", numbers(row_blocks)).groupBy("i", "j")).applyInArrow(
        _best_of_label(scale, width, primes, positives), "anchor_id long, row_id long, score long"
    )
    best = _ranked(near, ["anchor_id"], positives, "rank")
    lists = best.groupBy("anchor_id").agg(F.collect_list(F.struct("row_id", "score")).alias("positives"))
    lists = materialize(lists, "positives")
    asking = anchors.join(lists, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    hard = rows.cogroup(asking.withColumn("j", numbers(row_blocks)).groupBy("i", "j")).applyInArrow(
        _best_in_windows(scale, width, primes, positives, negatives, low, high),
        "anchor_id long, positive_id long, positive_score long, row_id long, score long",
    )
    return _ranked(hard, ["anchor_id", "positive_id", "positive_score"], negatives, "rank").select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("row_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
