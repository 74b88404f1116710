"""Benchmark passages in documents, exact or with a bounded number of edits."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowkit.llm.chunks import slices
from flowkit.session import materialize

#: Bytes of test items that are sent to the tasks at once; more go in further rounds.
BLOCK_BYTES = 4 << 20


def normal(text: str) -> str:
    """Lower case, every run of white space one space, none at the ends."""
    return " ".join(text.lower().split())


def budget(length: int, edit_rate: float) -> int:
    """Edits allowed for an item of ``length`` characters."""
    return int(length * edit_rate)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """The item in ``edits + 1`` pieces, nearly equal, with the place of each.

    Fewer edits than pieces leave one piece as it is.
    """
    count = min(edits + 1, len(item))
    cuts = [len(item) * i // count for i in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_match(item: str, text: str, edits: int) -> tuple[int, int] | None:
    """Least edit distance of the item to any stretch of the text, and the end of the first such.

    Myers' bit-parallel recurrence: one bit per character of the item, one
    step per character of the text. None if more than ``edits`` are needed.
    """
    size = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << i)
    top, full = 1 << (size - 1), (1 << size) - 1
    plus, minus, score = full, 0, size
    best = None
    for at, c in enumerate(text):
        same = masks.get(c, 0)
        vertical = same | minus
        across = (((same & plus) + plus) ^ plus) | same
        up = minus | (full & ~(across | plus))
        down = plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        # A match may begin anywhere, so nothing is carried in from above.
        up = (up << 1) & full
        down = (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score <= edits and (best is None or score < best[0]):
            best = (score, at + 1)
            if not score:
                break
    return best


@dataclass(frozen=True)
class _Items:
    """Test items of one round: normal text and edit budget by id, and the automaton of their pieces."""

    texts: tuple[tuple[int, str], ...]
    edit_rate: float

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text) in enumerate(self.texts):
            for at, piece in pieces(text, budget(len(text), self.edit_rate)):
                found.setdefault(piece, []).append((number, at))
        automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            automaton.add_word(piece, (len(piece), where))
        automaton.make_automaton()
        return automaton


def matches(text: str, items: _Items) -> list[tuple[int, int, int, int]]:
    """Item id, edits, and the place of the match in the normal text, of every item that the text holds.

    A piece hit at a place puts the item's start near one place; hits whose
    stretches overlap are verified together.
    """
    windows: dict[int, list[tuple[int, int]]] = {}
    for end, (size, where) in items.automaton.iter(text):
        begin = end + 1 - size
        for number, at in where:
            item = items.texts[number][1]
            edits = budget(len(item), items.edit_rate)
            first, last = max(0, begin - at - edits), min(len(text), begin - at + len(item) + edits)
            known = windows.setdefault(number, [])
            if known and first <= known[-1][1]:
                known[-1] = (min(known[-1][0], first), max(known[-1][1], last))
            else:
                known.append((first, last))
    out = []
    for number, stretches in windows.items():
        item_id, item = items.texts[number]
        edits = budget(len(item), items.edit_rate)
        best = None
        for first, last in stretches:
            found = best_match(item, text[first:last], edits)
            if found and (best is None or found[0] < best[0]):
                best = (found[0], first + found[1])
            if best and not best[0]:
                break
        if best:
            out.append((item_id, best[0], max(0, best[1] - len(item)), best[1]))
    return out


_LEAKS = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()), ("first", pa.int32()), ("last", pa.int32())]
)


def _scan(items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                rows += [(doc_id, *m) for m in matches(normal(text), items.value)]
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _LEAKS)], schema=_LEAKS
            )

    return run


def _rounds(benchmark: DataFrame, edit_rate: float, block_bytes: int) -> Iterator[_Items]:
    """The distinct items in rounds of at most about ``block_bytes`` bytes, read one partition at a time."""
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // block_bytes)
    dealt = rows.distinct().withColumn("round", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, count))))
    if count > 1:
        dealt = materialize(dealt, "items")
    for i in range(count):
        texts = sorted((r.item_id, normal(r.text)) for r in dealt.where(F.col("round") == i).collect())
        texts = tuple((n, t) for n, t in texts if t)
        if texts:
            yield _Items(texts, edit_rate)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, edit_rate: float = 0.08, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Test items (``item_id``, ``text``) that documents (``doc_id``, ``text``) hold.

    Texts are compared in lower case with single spaces. A document holds an
    item if some stretch of it is within ``edit_rate`` times the item's
    characters of edits (insert, delete, replace), rounded down. Each item is
    cut into one piece more than that; a stretch so close holds one piece as it
    is. Pieces are found with an automaton in one pass over the text, hits are
    verified with Myers' bit-parallel distance. Returns ``doc_id``,
    ``item_id``, ``edits`` and the stretch ``first``, ``last`` in the normal
    text (of the best match, the first of equals; its start is taken as an
    item's length before its end), one row per document row and item text.

    The items are a stated query set. They go to the tasks in rounds of
    ``block_bytes``, each one pass over the documents. Texts are not moved.
    Rows without a text, items without an id or words match nothing.
    """
    spark = docs.sparkSession
    plain = docs.where("text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    out = spark.createDataFrame([], "doc_id long, item_id long, edits int, first int, last int")
    for items in _rounds(benchmark, edit_rate, block_bytes):
        sent = spark.sparkContext.broadcast(items)
        out = out.union(plain.mapInArrow(_scan(sent), out.schema))
    return out


def _clean(items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            keep = [t is None or not matches(normal(t), items.value) for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, edit_rate: float = 0.08, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no test item; see ``find_leaks``."""
    for items in _rounds(benchmark, edit_rate, block_bytes):
        docs = docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(items)), docs.schema)
    return docs
