"""Token ids in compressed files of wavelet matrices."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowkit.llm.chunks import CUT, cut_up, gather, together
from flowkit.session import materialize, scratch_dir

_WORD = 64
#: Words to a block; the ones before each block are kept.
_BLOCK = 8
#: Ids in a shard: what one row of a file, and one matrix, holds.
SHARD_IDS = 1 << 20


class WaveletMatrix:
    """A sequence of ids as bit planes with rank and select.

    Plane by plane, from the highest bit, ids are dealt stably into those with
    a zero and those with a one, which is the order of the next plane. Per
    plane there are the bits, the number of ones before every block of 512,
    and the number of zeros.
    """

    def __init__(self, size: int, planes: list[np.ndarray], zeros: list[int], ones: list[np.ndarray]):
        self.size, self.planes, self.zeros, self.ones = size, planes, zeros, ones

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        values = pa.array(ids.astype(np.uint16 if len(ids) == 0 or ids.max() < 1 << 16 else np.uint32))
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        planes, zeros, ones = [], [], []
        for level in range(bits - 1, -1, -1):
            plain = values.to_numpy(zero_copy_only=False)
            bit = (plain >> plain.dtype.type(level)) & plain.dtype.type(1)
            packed = np.zeros(_blocks(len(plain)) * _BLOCK * 8, np.uint8)
            own = np.packbits(bit.astype(bool), bitorder="little")
            packed[: len(own)] = own
            planes.append(packed.view(np.uint64))
            counts = np.bitwise_count(planes[-1]).reshape(-1, _BLOCK).sum(1, dtype=np.int64)
            ones.append((np.cumsum(counts) - counts).astype(np.uint32))
            one = pa.BooleanArray.from_buffers(pa.bool_(), len(plain), [None, pa.py_buffer(packed)])
            low, high = values.filter(pc.invert(one)), values.filter(one)
            zeros.append(len(low))
            values = pa.concat_arrays([low, high])
        return cls(len(ids), planes, zeros, ones)

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place of a plane."""
        plane, word = self.planes[level], at // _WORD
        below = (np.uint64(1) << (at % _WORD).astype(np.uint64)) - np.uint64(1)
        count = self.ones[level][word // _BLOCK].astype(np.int64) + np.bitwise_count(plane[word] & below)
        first = word - word % _BLOCK
        for k in range(_BLOCK - 1):
            count += np.where(first + k < word, np.bitwise_count(plane[first + k]), 0)
        return count

    def access(self, places: np.ndarray) -> np.ndarray:
        """The ids at some places."""
        at = np.asarray(places, np.int64)
        value = np.zeros(len(at), np.int64)
        for level, plane in enumerate(self.planes):
            bit = ((plane[at // _WORD] >> (at % _WORD).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            ones = self._rank(level, at)
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
            value = value * 2 + bit
        return value

    def _interval(self, value: int, last: int) -> tuple[int, int]:
        first, last = 0, last
        for level in range(len(self.planes)):
            a, b = self._rank(level, np.array([first, last]))
            if (value >> (len(self.planes) - 1 - level)) & 1:
                first, last = self.zeros[level] + int(a), self.zeros[level] + int(b)
            else:
                first, last = first - int(a), last - int(b)
        return first, last

    def count(self, value: int, before: int | None = None) -> int:
        """How often an id stands before a place, or at all."""
        if value >> len(self.planes):
            return 0
        first, last = self._interval(value, self.size if before is None else before)
        return last - first

    def occurrences(self, value: int) -> np.ndarray:
        """All places of an id, by walking back up the planes with select."""
        if value >> len(self.planes):
            return np.empty(0, np.int64)
        first, last = self._interval(value, self.size)
        at = np.arange(first, last)
        for level in range(len(self.planes) - 1, -1, -1):
            one = (value >> (len(self.planes) - 1 - level)) & 1
            at = self._select(level, at - self.zeros[level] if one else at, one)
        return at

    def _select(self, level: int, number: np.ndarray, one: int) -> np.ndarray:
        """Where the zeros or ones with some numbers stand in a plane."""
        before = self.ones[level].astype(np.int64)
        if not one:
            before = np.arange(len(before)) * _BLOCK * _WORD - before
        block = np.searchsorted(before, number, side="right") - 1
        words = self.planes[level].reshape(-1, _BLOCK)[block]
        bits = np.unpackbits((words if one else ~words).view(np.uint8), axis=1, bitorder="little")
        nth = (number - before[block] + 1)[:, None]
        return block * _BLOCK * _WORD + (np.cumsum(bits, axis=1, dtype=np.int32) == nth).argmax(1)

    def all(self) -> np.ndarray:
        """Every id, in order, by undoing the deals from the last plane."""
        values = np.zeros(self.size, np.uint32 if len(self.planes) > 16 else np.uint16)
        for level in range(len(self.planes) - 1, -1, -1):
            shift = len(self.planes) - 1 - level
            one = pa.BooleanArray.from_buffers(pa.bool_(), self.size, [None, pa.py_buffer(self.planes[level])])
            low, high = values[: self.zeros[level]], values[self.zeros[level] :] | values.dtype.type(1 << shift)
            merged = pc.replace_with_mask(pa.array(np.zeros_like(values)), one, pa.array(high))
            values = pc.replace_with_mask(merged, pc.invert(one), pa.array(low)).to_numpy(zero_copy_only=False)
        return values

    def to_bytes(self) -> bytes:
        """Number of ids and of planes, zeros of each plane, ones before its blocks, its bits; all little-endian."""
        head = np.array([self.size, len(self.planes), *self.zeros], "<u8")
        ones, planes = (x.astype("<u4").tobytes() for x in self.ones), (x.astype("<u8").tobytes() for x in self.planes)
        return b"".join([head.tobytes(), *ones, *planes])

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        size, bits = (int(x) for x in np.frombuffer(raw, "<u8", 2))
        zeros = [int(x) for x in np.frombuffer(raw, "<u8", bits, 16)]
        blocks, at = _blocks(size), 16 + 8 * bits
        ones = [np.frombuffer(raw, "<u4", blocks, at + 4 * blocks * i) for i in range(bits)]
        at += 4 * blocks * bits
        words = blocks * _BLOCK
        planes = [np.frombuffer(raw, "<u8", words, at + 8 * words * i) for i in range(bits)]
        return cls(size, planes, zeros, ones)


def _blocks(size: int) -> int:
    """Blocks of a plane; the last is never full, so every place has one."""
    return size // (_WORD * _BLOCK) + 1


def _byte_of() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}


# Fixed value: how the tokenizer cuts texts before it merges bytes.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose classes no version of Unicode changed; texts of others go to the library as they are.
_UNSETTLED = r"[^\x00-\x{24f}\x{2010}-\x{2027}\x{20ac}]"
#: White space that the cutter would have to go back over step by step, and what every such run has.
_LONG_SPACE = re.compile(r"\s{1000}")
_DOUBLE_SPACE = ("  ", "\n\n", "\n ", " \n", *"\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0")
#: White space at the end of a chunk, or behind the space or line break that it begins with.
_EDGES = r"[\t-\r\x1c-\x20\x{85}\x{a0}]$|^[ \n][\t-\r\x1c-\x20\x{85}\x{a0}]"
#: Characters of texts whose distinct chunks are looked for together.
_TOGETHER = 16 << 20


class ByteCoder:
    """Gives the ids that the tokenizers library gives, at a small part of its time.

    Texts are cut by the same pattern and merged by the same vocabulary in
    tiktoken. The pattern cuts before a single space, and at a single line
    break, between other characters, so what lies between two of them is a
    chunk with ids of its own, and of many texts together each distinct chunk
    is merged once. Texts with other white space beside a space or break are
    merged whole. The library itself encodes texts with special tokens,
    letters beyond Latin or very long runs of white space, and all texts where
    its file asks for anything else.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = [t["content"] for t in model["added_tokens"]]
        self.odd = "|".join([_UNSETTLED, *map(re.escape, special)])
        vocabulary, byte_of = model["model"]["vocab"], _byte_of()
        ranks = {
            bytes(byte_of[c] for c in token): number for token, number in vocabulary.items() if token not in special
        }
        self.merger = tiktoken.Encoding("ids", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        self.lengths[list(ranks.values())] = [len(token) for token in ranks]
        cutter = model["pre_tokenizer"] or {}
        self.by_rank = (
            cutter.get("type") == "ByteLevel"
            and cutter.get("use_regex", True)
            and not cutter.get("add_prefix_space")
            and model["normalizer"] is None
            and self._merges_by_rank(model["model"], ranks, byte_of)
        )

    @staticmethod
    def _merges_by_rank(model: dict, ranks: dict[bytes, int], byte_of: dict[str, int]) -> bool:
        """Whether earlier merges make tokens of smaller numbers, as the merger takes for granted."""
        made = []
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made.append(ranks.get(bytes(byte_of[c] for c in left + right), -1))
        return all(a < b for a, b in zip(made, made[1:])) and (not made or made[0] >= 0)

    def _plain(self, texts: list[str]) -> list[bool]:
        """Whether both libraries are known to agree on a text."""
        if not self.by_rank:
            return [False] * len(texts)
        odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), self.odd).to_pylist()
        return [
            not (o or any(s in t for s in _DOUBLE_SPACE) and _LONG_SPACE.search(t)) for o, t in zip(odd, texts)
        ]

    def _merge(self, chunks: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks one behind the other, and how many each has; odd ones get none.

        Those that begin with a space or a line break are cut from whatever
        stands before them, so they are merged in one call, and the bytes of
        the ids say where each chunk ends.
        """
        sizes = np.zeros(len(chunks), np.int64)
        cut = pc.match_substring_regex(chunks, r"^[ \n]").to_numpy(zero_copy_only=False)
        one_call, alone = np.flatnonzero(cut & ~odd), np.flatnonzero(~cut & ~odd)
        some = chunks.take(pa.array(one_call))
        wanted = np.cumsum(pc.binary_length(some).to_numpy())
        # The chunks taken lie one behind the other.
        text = some.buffers()[2].slice(0, int(wanted[-1])).to_pybytes().decode() if len(some) else ""
        ids = np.array(self.merger.encode_ordinary(text), np.int32)
        ends = np.cumsum(self.lengths[ids])
        at = np.searchsorted(ends, wanted)
        if len(at) and (at[-1] >= len(ends) or (ends[at] != wanted).any()):
            raise ValueError("an id reaches from one chunk into the next")
        sizes[one_call] = np.diff(at + 1, prepend=0)
        own = [np.array(self.merger.encode_ordinary(c), np.int32) for c in chunks.take(pa.array(alone)).to_pylist()]
        sizes[alone] = [len(o) for o in own]
        begins, flat = np.cumsum(sizes) - sizes, np.empty(int(sizes.sum()), np.int32)
        joined = np.ones(len(flat), bool)
        for i, o in zip(alone.tolist(), own):
            flat[begins[i] : begins[i] + len(o)] = o
            joined[begins[i] : begins[i] + len(o)] = False
        flat[joined] = ids
        return flat, sizes

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without special tokens."""
        plain = self._plain(texts)
        marked = [
            t.replace(" ", "\0 ").replace("\n", "\0\n").removeprefix(CUT) if ok and "  " not in t and CUT not in t else ""
            for t, ok in zip(texts, plain)
        ]
        chunks, numbers, counts = cut_up(marked)
        odd = pc.match_substring_regex(chunks, _EDGES).to_numpy(zero_copy_only=False).astype(bool)
        flat, sizes = self._merge(chunks, odd)
        ids, sizes = gather(flat, np.concatenate([[0], np.cumsum(sizes)]), numbers, counts)
        within = np.concatenate([[0], np.cumsum(odd[numbers])])
        cuts = np.concatenate([[0], np.cumsum(counts)])
        whole = (counts == 0) | (np.diff(within[cuts]) > 0)
        out = np.split(ids, np.cumsum(sizes)[:-1]) if texts else []
        for i in np.flatnonzero(whole).tolist():
            if plain[i]:
                out[i] = np.array(self.merger.encode_ordinary(texts[i]), np.int32)
            else:
                out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.int32)
        return out


@lru_cache(maxsize=2)
def _coder(path: str) -> ByteCoder:
    return ByteCoder(path)


_SHARD = pa.schema(
    [
        ("part", pa.int32()),
        ("number", pa.int32()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("matrix", pa.binary()),
    ]
)
_SHARD_DDL = "part int, number int, n_ids long, doc_ids array<long>, sizes array<long>, matrix binary"


def _shards(tokenizer: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, number = _coder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def shard():
            matrix = WaveletMatrix.build(np.concatenate(held)).to_bytes()
            row = [[part], [number], [size], [doc_ids], [[len(h) for h in held]], [matrix]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _SHARD)], schema=_SHARD)

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for a, b in together(texts, _TOGETHER):
                for doc_id, own in zip(ids[a:b], coder.encode(texts[a:b])):
                    doc_ids.append(doc_id)
                    held.append(np.append(own, np.int32(end_id)))
                    size += len(held[-1])
                    if size >= shard_ids:
                        yield shard()
                        doc_ids, held, size, number = [], [], 0, number + 1
        if held:
            yield shard()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, shard_ids: int = SHARD_IDS) -> None:
    """Encode documents and write their ids, in ascending order of ``doc_id``, as files of wavelet matrices.

    ``tokenizer`` is the file of a byte-level tokenizer that every executor
    can open; each document is followed by ``end_id``. A row of a file is a
    shard: its place in the order (``part``, ``number``), its documents with
    their numbers of ids, and the matrix. A shard ends with the document that
    fills it. A NULL text counts as empty; NULL ids come first, rows with one
    id in an order that follows from their texts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # With a hash of the text, rows of one id are no single range.
    ordered = plain.withColumn("hash", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash").drop("hash")
    (
        ordered.mapInArrow(_shards(tokenizer, end_id, shard_ids), _SHARD_DDL)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = WaveletMatrix.from_bytes(row["matrix"]).all().astype("<u4")
            ends = np.cumsum(row["sizes"])
            checks = [zlib.crc32(ids[b - n : b].tobytes()) for b, n in zip(ends.tolist(), row["sizes"])]
            n = len(ends)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * n, pa.int32()),
                    pa.array([row["number"]] * n, pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(ends - row["sizes"], pa.int64()),
                    pa.array(row["sizes"], pa.int64()),
                    pa.array(checks, pa.int64()),
                ],
                names=["part", "number", "doc_id", "inside", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files in a folder: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before. ``ids_crc32`` is over
    the ids as little-endian unsigned 32-bit integers, read from the matrix.
    """
    files = spark.read.schema(_SHARD_DDL).parquet(path)
    sizes = files.select("part", "number", "n_ids")
    # Ids before a file's part: one row per part.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "number", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("offset"))
    shards = materialize(
        starts.join(parts, "part").select("part", "number", (F.col("base") + F.col("offset")).alias("base")), "shards"
    )
    documents = files.select("part", "number", "doc_ids", "sizes", "matrix").mapInArrow(
        _read, "part int, number int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )
    return documents.join(shards, ["part", "number"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the ids of documents into the shared folder (or ``path``) and read them back.

    The ids are those of the tokenizers library, but most are not computed by
    it: tiktoken merges the bytes by the same pattern and vocabulary, and only
    texts of which it is not sure that both agree go to the library itself
    (``ByteCoder``). A NULL
    text counts as empty, NULL ids come first; see ``write_tokens`` for the
    files and ``read_tokens`` for the columns.
    """
    path = path or scratch_dir(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, shard_ids=shard_ids)
    return read_tokens(docs.sparkSession, path)
