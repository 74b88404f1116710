"""Collocations against a plain version, and the filters alone."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowkit.llm import filters
from flowkit.llm.phrases import _score, coded, find_phrases, packed, unpacked
from tests.llm.helpers import clashing


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def plain(rows, least=10, top=2000):
    counts, total = {}, Counter()
    for lang, text in rows:
        own = counts.setdefault(lang or "und" if lang is None else lang, Counter())
        for words in pieces(text):
            total["und" if lang is None else lang] += len(words)
            for n in (1, 2, 3):
                own.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and (q[:2] == p or q[1:] == p) for q, b in found.items()):
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def found(frame):
    assert frame.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in frame.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    return sorted(tuple(r) for r in frame.collect())


def texts(seed, n=60):
    r = random.Random(seed)
    words = ["Of", "the", "é", "Éa", "new", "york", "times", "a-b", "x y", "\x1c", "CITY"]
    weights = [8, 8, 3, 2, 5, 4, 4, 1, 1, 1, 1]
    out = []
    for _ in range(n):
        own = r.choices(words, weights, k=r.randint(0, 60))
        text = ""
        for w in own:
            phrase = "New York Times" if w == "new" and r.random() < 0.7 else w
            text += phrase + r.choice([" "] * 8 + ["\t", "  ", ". ", ",", "\n", "\r\n", "\x0b", ": "])
        out.append((r.choice(["en", "en", "de", None, "und", ""]), text))
    return out


@pytest.mark.parametrize(
    "options", [{}, {"block_bytes": 200, "fan_bits": 1, "bucket_entries": 100}, {"block_bytes": 500, "fan_bits": 2}]
)
def test_phrases_are_the_plain_version(spark, options):
    rows = texts(len(options))
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    assert found(find_phrases(docs, **options)) == plain(rows)
    assert found(find_phrases(docs, top=3, **options)) == plain(rows, top=3)


def test_lookups_that_are_not_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = texts(7)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        docs = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
        assert found(find_phrases(docs, block_bytes=400)) == plain(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_odd_rows(spark):
    rows = [("en", None), (None, None), ("en", ""), ("fr", "x y " * 30), ("fr", "a b. " * 12), ("de", "w " * 5000), (None, "q r s " * 10)]
    rows += [("en", "A b, a B; " * 10), ("en", "same same same " * 20)] * 2
    schema = "doc_id long, text string, lang string"
    docs = clashing(spark.createDataFrame([(None, t, lang) for lang, t in rows], schema))
    docs = docs.select("*", *[F.lit(1).alias(c) for c in ("word", "words", "counts", "codes", "f", "part", "a", "x")])
    assert found(find_phrases(docs)) == plain(rows)
    assert find_phrases(docs.limit(0)).collect() == []
    assert find_phrases(docs.where("text IS NULL")).collect() == []
    assert find_phrases(docs.where("text = ''")).collect() == []


def test_scores_are_exact(spark):
    values = [(10**13, 10**13 + 1, 10**13 + 3), (99_999_999_999_999, 99_999_999_999_999, 99_999_999_999_999), (10, 7 * 10**12, 10)]
    frame = spark.createDataFrame(values, "a long, l long, r long").select("*", _score("a", F.col("l"), F.col("r")).alias("s"))
    assert [r.s for r in frame.collect()] == [10**6 * a * a // (x * y) for a, x, y in values]


def test_words_of_pieces():
    codes, words = coded(["A b. C\té e".encode(), b"", b"x"])
    listed = [words[c - 1].decode() if c else "|" for c in codes.tolist()]
    assert listed == ["a", "b", "|", "c", "é e", "|", "|", "x"]


def test_frequent_words_have_small_numbers():
    codes, words = coded([b"rare often often. often"])
    assert words == [b"often", b"rare"] and codes.tolist() == [2, 1, 1, 0, 1]
    numbers = np.random.default_rng(1).integers(0, 2**31, 1000)
    assert unpacked(packed(numbers)).tolist() == numbers.tolist() and len(unpacked(packed(numbers[:0]))) == 0


@pytest.mark.parametrize("n, width", [(2, 1), (2, 20), (2, 42), (3, 1), (3, 13), (3, 20), (3, 21), (3, 22), (3, 41)])
def test_packing_can_be_undone(n, width):
    r = np.random.default_rng(n * width)
    ids = [r.integers(0, 1 << width, 500) for _ in range(n)]
    packing = filters.Packing(n, width)
    left, right = packing.pack(ids)
    assert (left < 1 << packing.half).all() and (right < 1 << packing.half).all()
    assert all((a == b).all() for a, b in zip(packing.unpack(left, right), ids))
    assert len(set(zip(left.tolist(), right.tolist()))) == len(set(zip(*(i.tolist() for i in ids))))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(0, 6), st.lists(st.tuples(st.integers(0), st.integers(0), st.integers(1, 2**40)), max_size=60))
def test_filters_give_back_what_they_got(half, skip, entries):
    skip = min(skip, half)
    mask = (1 << half) - 1
    rows = [np.array(c, t) for c, t in zip(zip(*[(a & mask, b & mask, c) for a, b, c in entries]), ("u8", "u8", "i8"))]
    left, right, counts = rows or (np.empty(0, "u8"), np.empty(0, "u8"), np.empty(0, "i8"))
    want = Counter()
    for a, b, c in zip(left.tolist(), right.tolist(), counts.tolist()):
        want[a, b] += c
    some, rest = [filters.counted(left[s], right[s], counts[s], half) for s in (slice(0, None, 2), slice(1, None, 2))]
    parts = []
    for own in (some, rest):
        buckets, sizes, made = filters.split(*own, half, skip)
        assert sum(sizes) == len(own[0])
        parts += list(zip(made, buckets))
    if parts:
        a, b, c = filters.merged(parts, half)
        assert dict(zip(zip(a.tolist(), b.tolist()), c.tolist())) == want
        assert list(zip(a.tolist(), b.tolist())) == sorted(want)
