"""Windows of symbols that documents share, found without comparing documents.

The deduplicators of repeated passages (``substrings``, ``suffixes``) ask of
every window of ``length`` symbols which is the smallest document id it starts
in. Three steps find what may be shared and bring it together:

1. Documents are dealt into blocks by a hash of id and text. Of every window the
   least k-gram, in a random order, is its anchor. Equal windows have equal
   anchors, and neighbouring windows mostly share theirs, so a block sends one
   hash for about every eighteen bytes, and each only once however many of its
   documents hold it.
2. Anchors that several documents hold come back to their blocks, which cut
   out the text around them: a segment is a run of windows with one anchor.
   A block sends each distinct segment once, with the places it stands at,
   to the bucket of its anchor.
3. In a bucket, shards of distinct segments get an index (an FM-index or a
   suffix array), which tells the earliest document of each window. A segment
   that is alone under its anchor, as within exact copies, needs none.

An anchor at more than ``hot`` places would bring all their distinct
surroundings into one bucket. Its windows are sent one by one under their own
hash instead: what is shared then meets once per block, what is not spreads
evenly.

Hashes only route: texts are compared before they are taken for the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a block, on average.
BLOCK_BYTES = 5 << 20
#: Places of an anchor above which its windows travel on their own.
HOT = 2048
#: Symbols that one index covers.
SHARD_SYMBOLS = 1 << 18
#: Bytes of text for which there is a bucket.
BUCKET_BYTES = 1 << 20
#: Windows of a document that are looked at together.
_PART = 1 << 19
_POSITION = np.uint64((1 << 20) - 1)
#: Bits of an anchor's hash that are not sent: 48 keep strangers apart well enough, and shuffles compress the rest away.
_UNUSED = np.uint64(16)
_BASE = 0x9E3779B97F4A7C15
#: Words are hashed to another base than windows of them.
_WORD_BASE, _WORD_LENGTH = 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93
_NEAR = 12
_POWERS = np.cumprod(np.full(1 << _NEAR, _WORD_BASE, np.uint64), dtype=np.uint64)

#: Segments sorted by key, the earliest document that holds each, and the keys, to the earliest document
#: of every window, segment by segment. Equal windows lie in segments of one key.
Resolver = Callable[[list[bytes], list[int], list[int]], np.ndarray]


@dataclass(frozen=True)
class Unit:
    """What a window consists of."""

    words: bool
    length: int
    gram: int

    def text(self, raw: bytes) -> bytes:
        """The text windows are cut from: as it is, or its words joined by a space."""
        return b" ".join(raw.split()) if self.words else raw

    def bounds(self, text: bytes) -> np.ndarray | None:
        """Where words start, and the end; nothing for bytes."""
        if not self.words:
            return None
        if not text:
            return np.zeros(1, np.int64)
        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        return np.concatenate([[0], spaces + 1, [len(text) + 1]])

    def symbols(self, text: bytes) -> tuple[np.ndarray, np.ndarray | None]:
        """A number for each symbol, and the bounds."""
        data, starts = np.frombuffer(text, np.uint8), self.bounds(text)
        if starts is None:
            return data.astype(np.uint64), None
        if not text:
            return np.empty(0, np.uint64), starts
        lengths = np.diff(starts)
        within = np.arange(len(data) + 1) - np.repeat(starts[:-1], lengths)
        weights = _POWERS[within & ((1 << _NEAR) - 1)]
        beyond = int(lengths.max()) >> _NEAR
        if beyond:
            # Powers go on in long words, so no two places of a word weigh the same.
            far = np.cumprod(np.full(beyond, pow(_WORD_BASE, 1 << _NEAR, 1 << 64), np.uint64), dtype=np.uint64)
            weights = weights * np.concatenate([np.ones(1, np.uint64), far])[within >> _NEAR]
        values = (np.append(data, np.uint8(32)).astype(np.uint64) + np.uint64(1)) * weights
        return _mixed(np.add.reduceat(values, starts[:-1]) + lengths.astype(np.uint64) * np.uint64(_WORD_LENGTH)), starts

    def cut(self, text: bytes, starts: np.ndarray | None, first: int, last: int) -> bytes:
        """Symbols ``first`` to ``last`` (exclusive)."""
        return text[first:last] if starts is None else text[starts[first] : starts[last] - 1]

    def count(self, text: bytes) -> int:
        """Symbols of a text that ``text`` has made."""
        return (text.count(b" ") + 1 if text else 0) if self.words else len(text)


class Block:
    """The documents of a block, in an order that does not depend on the run, as one run of symbols."""

    def __init__(self, unit: Unit, table: pa.Table):
        rows = sorted(zip(table.column("doc_id").to_pylist(), table.column("body").to_pylist()))
        self.unit = unit
        self.ids = np.array([i for i, _ in rows], np.int64)
        self.texts = [unit.text(body) for _, body in rows]
        self.joined = (b" " if unit.words else b"").join(t for t in self.texts if t)
        self.ends = np.cumsum([unit.count(t) for t in self.texts], dtype=np.int64)
        self.symbols, self.bounds = unit.symbols(self.joined)

    @cached_property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]])

    def runs(self, content: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows of one document with one anchor.

        Their first and last start, the anchor's hash and, if asked for, a
        hash of the symbols they cover.
        """
        return anchors(self.symbols, self.unit, self.starts, self.ends, content)

    def cover(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the text of symbols ``first`` to ``last`` (exclusive) begins and ends."""
        return (first, last) if self.bounds is None else (self.bounds[first], self.bounds[last] - 1)

    def differ(self, begin: np.ndarray, end: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Of some stretches, those whose text is not that of the stretch before them."""
        places = places[places > 0]
        other = end[places] - begin[places] != end[places - 1] - begin[places - 1]
        alike = places[~other].tolist()
        spans = [(int(begin[i]), int(end[i]), int(begin[i - 1]), int(end[i - 1])) for i in alike]
        more = [i for i, (a, b, c, d) in zip(alike, spans) if self.joined[a:b] != self.joined[c:d]]
        return np.concatenate([places[other], np.array(more, np.int64)])


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def contains(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def _hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` symbols from each place, by joining ever longer runs."""
    run, size, out, have, left = symbols, 1, None, 0, k
    while left:
        if left & 1:
            if out is None:
                out, have = run, size
            else:
                n = len(run) - have
                out = out[:n] * np.uint64(pow(_BASE, size, 1 << 64)) + run[have : have + n]
                have += size
        left >>= 1
        if left:
            run = run[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + run[size:]
            size *= 2
    return _mixed(out[: len(symbols) - k + 1].copy())


def _hashes_at(symbols: np.ndarray, k: int, places: np.ndarray) -> np.ndarray:
    """A hash of the ``k`` symbols from some places."""
    own = np.zeros(len(places), np.uint64)
    for i in range(k):
        own = own * np.uint64(_BASE) + symbols[places + i]
    return _mixed(own)


def _mixed(out: np.ndarray) -> np.ndarray:
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xC4CEB9FE1A85EC53)
    out ^= out >> np.uint64(33)
    return out


def anchors(
    symbols: np.ndarray, unit: Unit, starts: np.ndarray, ends: np.ndarray, content: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor, of texts that lie one behind the other; see ``Block.runs``."""
    length, width = unit.length, unit.length - unit.gram + 1
    # Windows that would reach into the next text.
    marks = np.zeros(len(symbols) + 1, np.int32)
    np.add.at(marks, np.maximum(starts, ends - length + 1), 1)
    np.add.at(marks, ends, -1)
    inside = np.cumsum(marks) == 0
    found: list[tuple[np.ndarray, ...]] = []
    for part in range(0, max(0, len(symbols) - length + 1), _PART):
        own = symbols[part : part + _PART + length - 1]
        grams = _hashes(own, unit.gram)
        least, size = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64), 1
        while size * 2 <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < width:
            least = np.minimum(least[: size - width], least[width - size :])
        at = (least & _POSITION).astype(np.int64)
        good = inside[part : part + len(at)]
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (good[1:] != good[:-1])]))
        last = np.append(new[1:] - 1, len(at) - 1)
        keep = good[new]
        new, last = new[keep], last[keep]
        covered = np.empty(0, np.uint64)
        if content:
            # The first and the last window hold all symbols of a run.
            windows = _hashes(own, length)
            covered = _mixed(windows[new] * np.uint64(_BASE) + windows[last] + (last - new).astype(np.uint64))
        found.append((new + part, last + part, grams[at[new]] >> _UNUSED, covered))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _sent_anchors(unit: Unit):
    def send(table: pa.Table) -> pa.Table:
        block = Block(unit, table)
        starts, _, key, _ = block.runs()
        # The same document twice is one holder of its anchors.
        same = np.concatenate([[0], np.cumsum(block.ids[1:] != block.ids[:-1])])
        held = same[np.searchsorted(block.ends, starts, side="right")]
        order = np.lexsort((held, key))
        key, held = key[order], held[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
        new = first | np.concatenate([[True], held[1:] != held[:-1]])[: len(key)]
        at = np.flatnonzero(first)
        return pa.table(
            {
                "key": key[at].view(np.int64),
                "block": np.full(len(at), table.column("block")[0].as_py(), np.int64),
                "holders": np.add.reduceat(new, at, dtype=np.int32) if len(at) else np.empty(0, np.int32),
                "places": np.diff(np.append(at, len(key))).astype(np.int32),
            }
        )

    return send


def _repeated(hot: int):
    """Of rows sorted by key, those whose key has more than one holder."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush(keys, blocks, holders, places):
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(at, len(keys)))
            keep = np.repeat(np.add.reduceat(holders, at) > 1, sizes)
            many = np.repeat(np.add.reduceat(places, at) > hot, sizes)
            return pa.RecordBatch.from_pydict({"block": blocks[keep], "key": keys[keep], "hot": many[keep]})

        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
            if held:
                new = [np.concatenate([a, b]) for a, b in zip(held, new)]
            # The last key may go on in the next batch.
            cut = int(np.searchsorted(new[0], new[0][-1]))
            if cut:
                yield flush(*[x[:cut] for x in new])
            held = [x[cut:].copy() for x in new]
        if held:
            yield flush(*held)

    return pick


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The stretches of an array between some cuts, each compressed."""
    compress = zstandard.ZstdCompressor(level=9).compress
    return pa.array([compress(values[a:b].tobytes()) for a, b in zip(cuts.tolist(), cuts[1:].tolist())], pa.binary())


def _unpacked(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    expand = zstandard.ZstdDecompressor().decompress
    return [np.frombuffer(expand(x.as_buffer()), kind) for x in column]


#: Per block and bucket: distinct segments (their texts and sizes in bytes, how many places each has, whether it is
#: a window that travels on its own), then the places.
_PARTS = ("texts", "sizes", "places", "single", "ids", "rows", "starts")
_SEGMENTS_DDL = "bucket long, block long, " + ", ".join(f"{n} binary" for n in _PARTS)
_SEGMENTS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), *[(n, pa.binary()) for n in _PARTS]])


def _sent_segments(unit: Unit, buckets: int):
    def send(documents: pa.Table, flagged: pa.Table) -> pa.Table:
        if not documents.num_rows or not flagged.num_rows:
            return _SEGMENTS.empty_table()
        keys = flagged.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        keys, hot = keys[order], flagged.column("hot").to_numpy()[order]
        block = Block(unit, documents)
        first, last, key, content = block.runs(True)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        known = keys[at] == key
        first, last, key, content, hot = first[known], last[known], key[known], content[known], hot[at[known]]
        if hot.any():
            # Each window by itself, under its own hash.
            sizes = (last - first + 1)[hot]
            single = np.arange(int(sizes.sum())) + np.repeat(first[hot] - np.cumsum(sizes) + sizes, sizes)
            own = _hashes_at(block.symbols, unit.length, single)
            first, last, key, content = (
                np.concatenate([old[~hot], new])
                for old, new in zip((first, last, key, content), (single, single, own, own))
            )
            hot = np.arange(len(first)) >= len(first) - len(single)
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((content, hot, bucket))
        first, last, content, hot, bucket = first[order], last[order], content[order], hot[order], bucket[order]
        new = np.concatenate([[True], (content[1:] != content[:-1]) | (hot[1:] != hot[:-1]) | (bucket[1:] != bucket[:-1])])
        new = new[: len(bucket)]
        begin, end = block.cover(first, last + unit.length)
        new[block.differ(begin, end, np.flatnonzero(~new))] = True
        heads = np.flatnonzero(new)
        sizes = (end - begin)[heads]
        texts = b"".join([block.joined[a:b] for a, b in zip(begin[heads].tolist(), end[heads].tolist())])
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[: len(bucket)])
        by_place = np.append(cuts, len(bucket))
        by_segment = np.searchsorted(heads, by_place)
        by_byte = np.concatenate([[0], np.cumsum(sizes)])[by_segment]
        rows = np.searchsorted(block.ends, first, side="right")
        places = np.diff(np.append(heads, len(bucket)))
        return pa.table(
            [
                pa.array(bucket[cuts]),
                pa.array(np.full(len(cuts), documents.column("block")[0].as_py(), np.int64)),
                _packed(np.frombuffer(texts, np.uint8), by_byte),
                _packed(sizes.astype(np.int32), by_segment),
                _packed(places.astype(np.int32), by_segment),
                _packed(hot[heads].astype(np.uint8), by_segment),
                _packed(block.ids[rows], by_place),
                _packed(rows.astype(np.int32), by_place),
                _packed((first - block.starts[rows]).astype(np.int32), by_place),
            ],
            schema=_SEGMENTS,
        )

    return send


#: Per bucket and block: the spans, sorted by row, with their sizes.
_SPANS_DDL = "block long, rows binary, firsts binary, sizes binary"


def _spans(unit: Unit, resolve: Resolver):
    """From the segments of a bucket, the spans of later copies in each document."""

    def work(table: pa.Table) -> pa.Table:
        sizes, places = (_unpacked(table.column(n), np.int32) for n in ("sizes", "places"))
        kinds = {"ids": np.int64, "rows": np.int32, "starts": np.int32}
        ids, rows, starts = (np.concatenate(_unpacked(table.column(n), k)) for n, k in kinds.items())
        blocks = np.repeat(table.column("block").to_numpy(), [int(p.sum()) for p in places])
        # Blocks may send the same segment.
        number: dict[bytes, int] = {}
        which: list[int] = []
        for packed, own in zip(_unpacked(table.column("texts"), np.uint8), sizes):
            text = packed.tobytes()
            ends = np.cumsum(own).tolist()
            which += [number.setdefault(text[a:b], len(number)) for a, b in zip([0, *ends], ends)]
        single = np.zeros(len(number), bool)
        single[which] = np.concatenate(_unpacked(table.column("single"), np.uint8)) > 0
        which = np.repeat(np.array(which), np.concatenate(places))
        early = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(early, which, ids)
        segments = list(number)
        counts = np.array([unit.count(s) for s in segments])
        # Every segment has one anchor; equal windows lie in segments with equal anchors, or travel on their own.
        joined = (b" " if unit.words else b"").join(segments)
        ends = np.cumsum(counts)
        symbols = unit.symbols(joined)[0]
        _, last, keys, _ = anchors(symbols, unit, ends - counts, ends)
        keys = keys[np.searchsorted(last, ends - unit.length)]
        keys[single] = _hashes_at(symbols, unit.length, (ends - counts)[single])
        order = np.argsort(keys, kind="stable")
        windows = (counts - unit.length + 1)[order]
        # A segment that is alone under its key has no window in common with another.
        other = keys[order][1:] != keys[order][:-1]
        shared = ~(np.concatenate([[True], other]) & np.concatenate([other, [True]]))
        firsts = np.repeat(early[order], windows)
        some = order[shared]
        if len(some):
            firsts[np.repeat(shared, windows)] = resolve(
                [segments[i] for i in some.tolist()], early[some].tolist(), keys[some].tolist()
            )
        at = np.cumsum(windows) - windows
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        low, high = np.minimum.reduceat(firsts, at), np.maximum.reduceat(firsts, at)
        which = place[which]
        whole = high[which] < ids
        out = [blocks[whole], rows[whole], starts[whole], starts[whole] + windows[which[whole]] + unit.length - 1]
        more: list[tuple[int, int, int, int]] = []
        for i in np.flatnonzero((low[which] < ids) & ~whole).tolist():
            own = firsts[at[which[i]] : at[which[i]] + windows[which[i]]]
            later = np.concatenate([[False], own < ids[i], [False]])
            edges = np.flatnonzero(later[1:] != later[:-1]) + starts[i]
            more += [(blocks[i], rows[i], a, b + unit.length - 1) for a, b in edges.reshape(-1, 2).tolist()]
        extra = np.array(more, np.int64).reshape(-1, 4)
        block, row, first, last = (np.concatenate([a, extra[:, i]]) for i, a in enumerate(out))
        order = np.lexsort((first, row, block))
        block, row, first, last = block[order], row[order], first[order], last[order]
        cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])[: len(block)])
        ends = np.append(cuts, len(block))
        columns = [_packed(x.astype(np.int32), ends) for x in (row, first, last - first)]
        return pa.table([pa.array(block[cuts], pa.int64()), *columns], names=["block", "rows", "firsts", "sizes"])

    return work


def _cleaned(unit: Unit):
    def clean(documents: pa.Table, spans: pa.Table) -> pa.Table:
        if not documents.num_rows:
            return _CLEANED.empty_table()
        none = [np.empty(0, np.int32)]
        rows, first, sizes = (np.concatenate(none + _unpacked(spans.column(c), np.int32)) for c in ("rows", "firsts", "sizes"))
        order = np.lexsort((first, rows))
        rows, first, last = rows[order], first[order], (first + sizes)[order]
        out = []
        block = Block(unit, documents)
        for row, (doc_id, text) in enumerate(zip(block.ids.tolist(), block.texts)):
            a, b = np.searchsorted(rows, [row, row + 1])
            bounds = unit.bounds(text)
            n = len(text) if bounds is None else len(bounds) - 1
            begin, end = first[a:b], np.maximum.accumulate(last[a:b]) if b > a else last[a:b]
            new = np.flatnonzero(begin[1:] > end[:-1]) + 1 if b > a else np.empty(0, int)
            begin = begin[np.concatenate([[0], new])] if b > a else begin
            end = end[np.append(new - 1, b - a - 1)] if b > a else end
            cuts = np.concatenate([[0], np.column_stack([begin, end]).ravel(), [n]]).astype(int).tolist()
            kept = [unit.cut(text, bounds, x, y) for x, y in zip(cuts[::2], cuts[1::2]) if y > x]
            out.append(
                {
                    "doc_id": doc_id,
                    "n_symbols": n,
                    "n_removed": int((end - begin).sum()),
                    "spans": [{"first": int(x), "last": int(y)} for x, y in zip(begin, end)],
                    "kept": (b" " if unit.words else b"").join(kept),
                }
            )
        return pa.Table.from_pylist(out, schema=_CLEANED)

    return clean


_CLEANED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
        ("kept", pa.binary()),
    ]
)
_CLEANED_DDL = "doc_id long, n_symbols long, n_removed long, spans array<struct<first:int,last:int>>, kept binary"


def remove_later_copies(
    docs: DataFrame,
    unit: Unit,
    resolve: Resolver,
    hot: int = HOT,
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Cut out every window that also starts in a document with a smaller id.

    ``docs`` has ``doc_id`` and ``text``; other columns are left out. Returns
    per row ``doc_id``, ``n_symbols``, ``n_removed``, ``spans`` (maximal
    removed runs) and ``kept`` (bytes). A NULL text counts as empty. A row
    with a NULL id comes back whole and is earlier than no other. Rows with
    one id are never earlier than each other.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"))
    total = plain.agg(F.sum(F.length("body"))).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    known = plain.where("doc_id IS NOT NULL").select(
        F.pmod(F.xxhash64("doc_id", "body"), F.lit(count)).alias("block"), "doc_id", "body"
    )
    by_block = known.groupBy("block")
    sent = by_block.applyInArrow(_sent_anchors(unit), "key long, block long, holders int, places int")
    repeated = (
        sent.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_repeated(hot), "block long, key long, hot boolean")
    )
    buckets = max(1, -(-total // bucket_bytes))
    segments = by_block.cogroup(repeated.groupBy("block")).applyInArrow(_sent_segments(unit, buckets), _SEGMENTS_DDL)
    spans = segments.groupBy("bucket").applyInArrow(_spans(unit, resolve), _SPANS_DDL)
    cleaned = by_block.cogroup(spans.groupBy("block")).applyInArrow(_cleaned(unit), _CLEANED_DDL)
    nameless = plain.where("doc_id IS NULL").mapInArrow(_untouched(unit), _CLEANED_DDL)
    return cleaned.unionByName(nameless)


def _untouched(unit: Unit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [unit.text(x) for x in batch.column("body").to_pylist()]
            sizes = [len(t.split()) if unit.words else len(t) for t in texts]
            rows = [
                {"doc_id": None, "n_symbols": n, "n_removed": 0, "spans": [], "kept": t}
                for t, n in zip(texts, sizes)
            ]
            yield from pa.Table.from_pylist(rows, schema=_CLEANED).to_batches()

    return run
