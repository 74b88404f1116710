"""Phrases whose words stand together more often than apart, counted in quotient filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowkit.llm.filters import Packing, counted, merged, split
from flowkit.operators.hot import spread_join
from flowkit.session import materialize

#: Bytes of text of one language that make a block.
BLOCK_BYTES = 8 << 20
#: Bytes of text that a task holds before it writes blocks.
_HELD_BYTES = 32 << 20
#: A merge takes 2**FAN_BITS filters at most, and a filter is split by so many bits.
FAN_BITS = 8
#: N-grams, before they are merged, for which there is a bucket.
BUCKET_ENTRIES = 1 << 22
#: Words are numbered in so many parts, side by side.
_PARTS = 256
#: Parts of a language that are ranked side by side.
_SALTS = 16
#: The language of documents without one.
UNKNOWN = "und"
_SIZES = (2, 3)

_BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")


def coded(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words of lower-cased texts as numbers from 1, the most frequent first, with a 0 between pieces, and the words."""
    joined = b"\n".join(texts).lower().translate(_BREAKS).replace(b"\n", b" \n ")
    words = pc.split_pattern(pa.array([joined], pa.large_binary()), pattern=b" ").flatten().dictionary_encode()
    listed = words.dictionary.to_pylist()
    number = np.zeros(len(listed), np.uint32)
    at = words.indices.to_numpy()
    counts = np.bincount(at, minlength=len(listed))
    kept = [i for i in np.argsort(-counts, kind="stable").tolist() if listed[i] and listed[i] != b"\n"]
    number[kept] = np.arange(1, len(kept) + 1)
    empty = np.array([not w for w in listed], bool)
    return number[at[~empty[at]]], [listed[i] for i in kept]


def packed(codes: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes; frequent words have small numbers, so that takes little."""
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


_BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("lang", pa.string()),
        ("words", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
        ("codes", pa.binary()),
    ]
)
_BLOCK_DDL = "block long, lang string, words array<string>, counts array<long>, codes binary"


def _blocks(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Numbers of blocks only have to differ within the table that is written.
        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        total = 0

        def write(lang: str) -> pa.RecordBatch:
            nonlocal number, total
            codes, words = coded(held.pop(lang))
            total -= sizes.pop(lang)
            counts = np.bincount(codes, minlength=len(words) + 1)[1:]
            number += 1
            row = [[number - 1], [lang], [[w.decode() for w in words]], [counts], [packed(codes)]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _BLOCK)], schema=_BLOCK)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist()):
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text) + 1
                total += len(text) + 1
                if sizes[lang] >= block_bytes:
                    yield write(lang)
                elif total >= _HELD_BYTES:
                    yield write(max(sizes, key=sizes.__getitem__))
        for lang in list(held):
            yield write(lang)

    return run


_FILTERS = pa.schema(
    [("lang", pa.string()), ("n", pa.int32()), ("shard", pa.int64()), ("bucket", pa.int64()), ("filter", pa.binary())]
)
_FILTERS_DDL = "lang string, n int, shard long, bucket long, filter binary"


def _filter_rows(rows: list[tuple]) -> pa.Table:
    if not rows:
        return _FILTERS.empty_table()
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _FILTERS)], schema=_FILTERS)


def _block_filters(width: int, bits: int):
    """The n-grams of one block, counted, as a filter per size and bucket; words that are too rare break them."""

    def work(block: pa.Table, numbers: pa.Table) -> pa.Table:
        out = []
        for lang, shard, codes in zip(*(block.column(c).to_pylist() for c in ("lang", "block", "codes"))):
            own = unpacked(codes)
            ids = np.zeros(int(own.max(initial=0)) + 1, np.int64)
            ids[numbers.column("code").to_numpy()] = numbers.column("id").to_numpy()
            ids = ids[own]
            for n in _SIZES:
                parts = [ids[k : len(ids) - n + 1 + k] for k in range(n)]
                whole = np.logical_and.reduce([p > 0 for p in parts]) if len(ids) >= n else np.zeros(0, bool)
                if not whole.any():
                    continue
                packing = Packing(n, width)
                left, right = packing.pack([p[whole] for p in parts])
                found = counted(left, right, np.ones(len(left), np.int64), packing.half)
                buckets, _, filters = split(*found, packing.half, min(bits, packing.half))
                out += [(lang, n, shard, b, f) for b, f in zip(buckets, filters)]
        return _filter_rows(out)

    return work


def _merge(table: pa.Table, width: int) -> tuple[str, Packing, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    packing = Packing(table.column("n")[0].as_py(), width)
    filters = list(zip(table.column("filter").to_pylist(), table.column("bucket").to_pylist()))
    return table.column("lang")[0].as_py(), packing, merged(filters, packing.half)


def _finer(width: int, bits: int):
    """One filter of several shards, split into finer buckets."""

    def work(table: pa.Table) -> pa.Table:
        lang, packing, found = _merge(table, width)
        buckets, _, filters = split(*found, packing.half, min(bits, packing.half))
        shard = table.column("shard")[0].as_py()
        return _filter_rows([(lang, packing.n, shard, b, f) for b, f in zip(buckets, filters)])

    return work


_GRAMS = pa.schema([("lang", pa.string()), ("n", pa.int32()), *[(c, pa.int64()) for c in ("x", "y", "z", "a")]])
_GRAMS_DDL = "lang string, n int, x long, y long, z long, a long"


def _frequent(width: int, least: int):
    """The n-grams of a bucket, from all its shards, that are frequent enough."""

    def work(table: pa.Table) -> pa.Table:
        lang, packing, (left, right, counts) = _merge(table, width)
        enough = counts >= least
        ids = packing.unpack(left[enough], right[enough])
        size = int(enough.sum())
        third = pa.array(ids[2]) if packing.n == 3 else pa.nulls(size, pa.int64())
        columns = [pa.array([lang] * size, pa.string()), pa.array([packing.n] * size, pa.int32())]
        return pa.table([*columns, pa.array(ids[0]), pa.array(ids[1]), third, pa.array(counts[enough])], schema=_GRAMS)

    return work


def count_grams(
    blocks: DataFrame,
    numbers: DataFrame,
    width: int,
    least: int,
    entries: int,
    shards: int,
    fan_bits: int = FAN_BITS,
    bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """All n-grams of ids that occur ``least`` times in a language: ``lang``, ``n``, ids ``x``, ``y``, ``z``, count ``a``.

    ``blocks`` has ``block``, ``lang``, ``codes``; ``numbers`` the ``id`` of each
    ``code`` of a ``block`` whose word is frequent. Filters of shards are
    merged, at most ``2**fan_bits`` at a time, into ever finer buckets, until
    a bucket has about ``bucket_entries`` of the ``entries`` and few enough
    shards to be merged at once.
    """
    bits = max(0, -(-entries // bucket_entries) - 1).bit_length()
    now, fan = min(bits, fan_bits), 1 << fan_bits
    filters = (
        blocks.select("block", "lang", "codes")
        .groupBy("block")
        .cogroup(numbers.groupBy("block"))
        .applyInArrow(_block_filters(width, now), _FILTERS_DDL)
    )
    while now < bits or shards > fan:
        now, shards = min(bits, now + fan_bits), max(1, shards >> fan_bits)
        filters = (
            filters.withColumn("shard", F.pmod(F.xxhash64("shard"), F.lit(shards)))
            .groupBy("lang", "n", "shard", "bucket")
            .applyInArrow(_finer(width, now), _FILTERS_DDL)
        )
    return filters.groupBy("lang", "n", "bucket").applyInArrow(_frequent(width, least), _GRAMS_DDL)


def _score(a: str, left: Column, right: Column) -> Column:
    """``floor(1000000 * a * a / (left * right))``, exact for counts below 10**14."""
    wide = [c.cast("decimal(14,0)") for c in (F.col(a), left, right)]
    columns = {"a": wide[0], "l": wide[1], "r": wide[2]}
    top = columns["a"] * columns["a"] * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, columns["l"] * columns["r"])


def find_phrases(
    docs: DataFrame,
    least: int = 10,
    inside: int = 50,
    top: int = 2000,
    block_bytes: int = BLOCK_BYTES,
    fan_bits: int = FAN_BITS,
    bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """The best collocations of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    ``docs`` has ``lang`` and ``text``; other columns are left out, a NULL
    text counts as empty, a NULL language as ``und``, and every row counts,
    repeated ones too. Texts are lower-cased (A-Z) and cut into pieces at
    punctuation and line ends, pieces into words at spaces and tabs. A phrase
    of 2 or 3 words that occurs ``a >= least`` times within pieces is a
    candidate. It is cut into two parts, which occur ``l`` and ``r`` times, so
    that ``floor(1000000 * a * a / (l * r))`` is least. Candidates within a
    longer one that occurs in ``inside`` hundredths of their places are
    dropped. The first ``top`` of each language by score, ``a`` and phrase
    come back, with the number ``n`` of its words. No text, no row.

    Tasks number the words of blocks of text. Words that are frequent enough
    (a candidate has no others) get ids per language; a block's n-grams of
    ids, permuted, go into counting quotient filters, and the sorted filters
    of all blocks are merged bucket by bucket. Texts are read once and never
    moved; blocks and candidates are written to the shared folder.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    plain = docs.select(lang.alias("lang"), body.alias("body"))
    blocks = materialize(plain.mapInArrow(_blocks(block_bytes), _BLOCK_DDL), "word-blocks")
    words = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select(
        "block", "lang", (F.col("at") + 1).cast("int").alias("code"), F.col("w.words").alias("word"), F.col("w.counts").alias("n")
    )
    counts = words.groupBy("lang", "word").agg(F.sum("n").alias("f"))
    # Numbered part by part, side by side: the numbers have few gaps, and no part grows beyond a share of the words.
    part = F.pmod(F.xxhash64("lang", "word"), F.lit(_PARTS))
    within = Window.partitionBy("lang", "part").orderBy("word")
    number = (F.row_number().over(within) - 1).cast("long") * _PARTS + F.col("part") + 1
    known = counts.where(F.col("f") >= least).withColumn("part", part).withColumn("id", number).drop("part")
    known = materialize(known.select("lang", "word", "id", "f"), "frequent-words")
    totals = materialize(
        blocks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c)).alias("n")), "totals"
    )
    width = max(1, int(known.agg(F.max("id")).first()[0] or 0).bit_length())
    shards = blocks.count()
    entries = 2 * int(totals.agg(F.sum("n")).first()[0] or 0)
    numbers = words.join(known.select("lang", "word", "id"), ["lang", "word"]).select("block", "code", "id")
    # New names for the columns: both sides of the cogroup come from one table.
    numbers = numbers.toDF("block", "code", "id")
    grams = materialize(
        count_grams(blocks, numbers, width, least, entries, shards, fan_bits, bucket_entries), "phrases"
    )
    return rank_phrases(grams, known, totals, inside, top)


def rank_phrases(grams: DataFrame, known: DataFrame, totals: DataFrame, inside: int, top: int) -> DataFrame:
    """The best phrases of counted n-grams, the words behind their ids and the number of words per language."""

    first = known.select("lang", "id", F.col("word").alias("w1"), F.col("f").alias("f1"))
    second = known.select("lang", "id", F.col("word").alias("w2"), F.col("f").alias("f2"))
    pairs = grams.where("n = 2").select("lang", "x", "y", "a")
    pairs = spread_join(pairs, first, ["lang", "x"], ["lang", "id"], "inner")
    pairs = spread_join(pairs, second, ["lang", "y"], ["lang", "id"], "inner")
    pairs = materialize(pairs, "pairs")
    triples = grams.where("n = 3").select("lang", "x", "y", "z", "a")
    # Both pairs of a candidate are candidates.
    before = pairs.select(
        "lang", F.col("x").alias("p"), F.col("y").alias("q"), "w1", "f1", F.col("w2").alias("w"), F.col("a").alias("f12")
    )
    behind = pairs.select(
        "lang", F.col("x").alias("p"), F.col("y").alias("q"), F.col("w2").alias("w3"), F.col("f2").alias("f3"), F.col("a").alias("f23")
    )
    triples = spread_join(triples, before, ["lang", "x", "y"], ["lang", "p", "q"], "inner")
    triples = spread_join(triples, behind, ["lang", "y", "z"], ["lang", "p", "q"], "inner")
    early, late = _score("a", F.col("f1"), F.col("f23")), _score("a", F.col("f12"), F.col("f3"))
    triples = triples.withColumns({"s1": early, "s2": late}).select(
        "lang",
        F.concat_ws(" ", "w1", "w", "w3").alias("phrase"),
        "a",
        F.when(F.col("s1") <= F.col("s2"), F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(F.col("s1") <= F.col("s2"), F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    longer = grams.where("n = 3")
    longer = longer.select("lang", F.col("x").alias("p"), F.col("y").alias("q"), "a").union(longer.select("lang", "y", "z", "a"))
    longer = longer.groupBy("lang", "p", "q").agg(F.max("a").alias("most")).withColumnRenamed("lang", "in")
    inside_of = (F.col("lang") == F.col("in")) & (F.col("x") == F.col("p")) & (F.col("y") == F.col("q"))
    kept = pairs.join(longer, inside_of, "left")
    kept = kept.where(F.col("most").isNull() | (100 * F.col("most") < inside * F.col("a"))).select(
        "lang",
        F.concat_ws(" ", "w1", "w2").alias("phrase"),
        "a",
        F.col("f1").alias("l"),
        F.col("f2").alias("r"),
        _score("a", F.col("f1"), F.col("f2")).alias("score"),
    )
    best = [F.desc("score"), F.desc("a"), "phrase"]
    ranked = kept.unionByName(triples).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    for group in (["lang", "salt"], ["lang"]):
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*best)))
        ranked = ranked.where(F.col("rank") <= top)
    numbers = ("a", "l", "r", "n", "score")
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", *[F.col(c).cast("long").alias(c) for c in numbers]
    )
