"""Near-duplicates by SimHash, found with deletion variants of fingerprint halves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowkit.llm.chunks import slices
from flowkit.llm.components import component_roots
from flowkit.session import materialize

_SEED = 42
#: Fingerprints of a bucket that are compared at once; a larger bucket is split by a further key.
BUCKET = 4096


def simhash(text: bytes, shingle: int = 3) -> int:
    """Fingerprint of a text: bit by bit the majority of the XXH64 of its shingles.

    A-Z count as a-z; words are separated by ASCII white space. A text of
    fewer words is one shingle, one without words has fingerprint zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate([[0], spaces + 1])[: max(1, len(words) - shingle + 1)].tolist()
    ends = np.concatenate([spaces, [len(joined)]])[min(shingle, len(words)) - 1 :].tolist()
    digest, seed = xxhash.xxh64_intdigest, _SEED
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends)], np.uint64)
    ones = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        part = hashes[first : first + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body"):
            texts = batch.column("body").to_pylist()
            prints = np.array([simhash(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(prints)], names=["doc_id", "row", "print"]
            )

    return run


def _row_hash(docs: DataFrame) -> Column:
    """A hash of all columns that can be hashed; rows that agree in them count as repeated."""
    return F.xxhash64(*[F.col(f"`{n}`") for n, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id``, ``row`` (a hash of the row) and ``print``, the fingerprint as a signed long, per row of ``docs``."""
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_hash(docs).alias("row"), body.alias("body"))
    return plain.mapInArrow(_fingerprints(shingle), "doc_id long, row long, print long")


def _variants(prints: DataFrame) -> DataFrame:
    """Each half of a fingerprint with each of its 32 bits left out.

    Of two fingerprints that differ in at most three bits, one half differs in
    at most one, so they share the variant without that bit. A key holds the
    half (bit 37), the bit left out (bits 32 to 36) and what remains.
    """
    low = F.col("print").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("print", 32)

    def variant(i):
        # i is 0 to 31 for the low half, 32 to 63 for the high one.
        half = F.when(i < 32, low).otherwise(high)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), i.bitwiseAND(F.lit(31)))
        return half.bitwiseAND(F.bitwise_not(bit)).bitwiseOR(F.shiftleft(i.cast("long"), 32))

    keys = F.transform(F.sequence(F.lit(0), F.lit(63)), variant)
    return prints.select(F.explode(keys).alias("key"), "print")


def _bucket_links(prints: np.ndarray, key: int, distance: int) -> list[tuple[int, int]]:
    """Links that join all members of a bucket that a chain of its close pairs joins.

    Only pairs that this key is the first to find count: those that differ in
    the bit left out, or, for the first bit, that agree in the half; for the
    high half those that the low one did not find.
    """
    half, bit = (key >> 37) & 1, (key >> 32) & 31
    mask = np.uint64(1 << (bit + 32 * half))
    links = []
    left = prints
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            one = frontier.pop()
            differ = left ^ one
            near = np.bitwise_count(differ) <= distance
            if bit:
                near &= (differ & mask) != 0
            if half:
                near &= np.bitwise_count(differ & np.uint64(0xFFFFFFFF)) > 1
            if near.any():
                found = left[near]
                links += [(int(one), int(x)) for x in found]
                frontier += list(found)
                left = left[~near]
    return links


#: The bucket a fingerprint is in: the variant's key, the bits of the other half that no split has looked at, and a
#: number that stands for both and for what the splits have found.
_BUCKETS_DDL = "route long, base long, rest long, print long"


def _links(distance: int, bucket: int | None):
    """Links of the buckets of sorted rows; a bucket of more than ``bucket`` comes back as rows, to be split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, spilling = None, [], False

        def rows(links, key=None):
            pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            names = [pa.array([x] * len(pairs), pa.int64()) for x in key or (None,) * 3]
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), *names], names=["u", "v", "route", "base", "rest"]
            )

        def back(prints, key):
            return rows(np.column_stack([prints, prints]), key)

        def close():
            return rows(_bucket_links(np.concatenate(held), held_key[1], distance))

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(n).to_numpy() for n in ("route", "base", "rest")]
            prints = batch.column("print").to_numpy().view(np.uint64)
            new = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            starts = np.flatnonzero(np.concatenate([[True], new]))
            ends = np.append(starts[1:], len(prints))
            # Only buckets of several matter, and the last, which may go on.
            several = np.flatnonzero((ends - starts > 1) | (ends == len(prints)) | (starts == 0))
            for a, b in zip(starts[several].tolist(), ends[several].tolist()):
                key = tuple(int(k[a]) for k in keys)
                if key != held_key:
                    if held and not spilling and sum(map(len, held)) > 1:
                        yield close()
                    held_key, held, spilling = key, [], False
                held.append(prints[a:b].copy())
                if spilling or (bucket is not None and sum(map(len, held)) > bucket):
                    spilling = True
                    yield back(np.concatenate(held), key)
                    held = []
        if held and not spilling and sum(map(len, held)) > 1:
            yield close()

    return run


#: Parts that the rest of a half is cut into: one more than the bits that may differ there.
_CUTS = 4
#: Bits of the rest at which a bucket, of a thousand fingerprints at most, is not split any more.
_FEW_BITS = 9


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deal out the rows of large buckets by parts of the other half as well.

    Of at most three differing bits among the rest, one of four parts of it
    has none, so every close pair still meets in that part's bucket.
    """
    for batch in batches:
        route, base, rest = (batch.column(n).to_numpy() for n in ("route", "base", "rest"))
        prints = batch.column("u").to_numpy()
        unsigned = prints.view(np.uint64)
        in_high = (base >> 37) & 1 == 0
        other = np.where(in_high, unsigned >> np.uint64(32), unsigned & np.uint64(0xFFFFFFFF)).astype(np.int64)
        for mask in np.unique(rest):
            own = np.flatnonzero(rest == mask)
            bits = [k for k in range(32) if int(mask) >> k & 1]
            for number, part in enumerate(np.array_split(bits, _CUTS)):
                kept = sum(1 << int(k) for k in part)
                found = (route[own].view(np.uint64) ^ np.uint64(number + 1)) * np.uint64(0x9E3779B97F4A7C15)
                found ^= found >> np.uint64(29)
                found = (found ^ (other[own] & kept).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
                found ^= found >> np.uint64(32)
                columns = [found.view(np.int64), base[own], np.full(len(own), int(mask) & ~kept), prints[own]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["route", "base", "rest", "print"])


def close_prints(prints: DataFrame, distance: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links ``u``, ``v`` between distinct fingerprints ``print``.

    Each differs in at most ``distance`` (three or fewer) bits, and whatever a
    chain of such pairs joins they join too. A bucket gives fewer links than
    it has members, never all its pairs. One of more than ``bucket`` members is
    split by further bits, again and again, until so few bits are left that
    they bound it.
    """
    if not 0 <= distance <= 3:
        raise ValueError("variants find pairs that differ in three bits at most")
    # The first buckets are sorted by their key alone; the other columns are put beside it behind the shuffle.
    rows = _variants(prints).repartition("key").sortWithinPartitions("key").select(
        F.col("key").alias("route"), F.col("key").alias("base"), F.lit(0xFFFFFFFF).alias("rest"), "print"
    )
    out, bits = None, 32
    while True:
        last = bits <= _FEW_BITS
        found = materialize(
            rows.mapInArrow(_links(distance, None if last else bucket), "u long, v long, route long, base long, rest long"),
            "close-prints",
        )
        links = found.where("route IS NULL").select("u", "v")
        out = links if out is None else out.union(links)
        large = found.where("route IS NOT NULL")
        if last or large.isEmpty():
            return out
        rows = large.mapInArrow(_split, _BUCKETS_DDL).repartition("route").sortWithinPartitions("route", "base", "rest")
        # The largest part of the rest is gone from some buckets, the smallest from others.
        bits -= bits // _CUTS


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Fingerprint and component of each row of ``doc_id``, ``text``.

    Rows are linked if their fingerprints differ in at most ``distance`` bits.
    Returns ``doc_id``, ``print`` (signed long) and ``component_id``, the
    least ``doc_id`` that links reach, its own included. Equal fingerprints
    are one node. A NULL text counts as empty, and texts without words share
    fingerprint zero. Rows with a NULL id are linked but name no component;
    one of only such rows has NULL.
    """
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    rooted = _rooted(rows, distance, bucket)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    components = materialize(rooted.join(named, "root").select("print", "component_id"), "components")
    return rows.join(components, "print").select("doc_id", "print", "component_id")


def _rooted(rows: DataFrame, distance: int, bucket: int) -> DataFrame:
    """``print``, its ``least`` id and the ``root`` of its component, per distinct fingerprint; written."""
    least = materialize(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "prints")
    roots = component_roots(close_prints(least.select("print"), distance, bucket))
    rooted = least.join(roots, F.col("print") == F.col("node"), "left")
    return materialize(rooted.select("print", "least", F.coalesce("root", "print").alias("root")), "rooted")


def keep_one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 3, bucket: int = BUCKET) -> DataFrame:
    """The row of ``docs`` with the least ``doc_id`` of each component of near-duplicates, all columns.

    Of rows with that id the one with the least hash stays, of rows that
    agree in all columns one. A NULL id stays only where no row of the
    component has another.
    """
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    roots = _rooted(rows, distance, bucket).select("print", "root")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row", "copies")
    kept = materialize(
        rows.groupBy("print", "doc_id", "row")
        .agg(F.count("*").alias("copies"))
        .join(roots, "print")
        .groupBy("root")
        .agg(F.min(order).alias("kept"))
        .select("kept.doc_id", "kept.row", "kept.copies"),
        "kept",
    )
    marked = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"), _row_hash(docs).alias("row"))

    def chosen(which: DataFrame) -> DataFrame:
        same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("row") == F.col("kept_row"))
        keys = which.select(F.col("doc_id").alias("kept_id"), F.col("row").alias("kept_row"))
        return marked.join(keys, same, "left_semi")

    several = kept.where("copies > 1")
    out = chosen(kept.where("copies = 1")).select("doc.*")
    if several.isEmpty():
        return out
    return out.union(chosen(several).groupBy("id", "row").agg(F.first("doc").alias("doc")).select("doc.*"))
