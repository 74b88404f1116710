"""Repeated words and bytes against a plain version."""

import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowkit.llm import windows
from flowkit.llm.substrings import FMIndex, RangeMinimum, WaveletTree, fm_resolver, substring_dedup
from flowkit.llm.suffixes import _FIRST, byte_heads, common_prefixes, suffix_array, suffix_dedup, suffix_resolver
from flowkit.llm.windows import Unit, anchors
from tests.llm.helpers import clashing, corpus, frame


def plain(rows, size, words):
    """Removed symbols, spans and what is kept, straight from the definition."""
    cut = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) if words else list((t or "").encode()) for _, t in rows]
    first = {}
    for (i, _), s in zip(rows, cut):
        for a in range(len(s) - size + 1):
            w = tuple(s[a : a + size])
            if i is not None:
                first[w] = min(first.get(w, i), i)
    out = []
    for (i, _), s in zip(rows, cut):
        gone = [False] * len(s)
        for a in range(len(s) - size + 1):
            if i is not None and first[tuple(s[a : a + size])] < i:
                gone[a : a + size] = [True] * size
        kept = [x for x, g in zip(s, gone) if not g]
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(s), sum(gone), spans, b" ".join(kept) if words else bytes(kept)))
    return sorted(out, key=repr)


def found(frame):
    rows = frame.selectExpr("doc_id", "n_symbols", "n_removed", "size(spans)", "kept").collect()
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in rows), key=repr)


# Small blocks, shards and bounds take every branch.
SMALL = [{}, {"block_bytes": 600, "bucket_bytes": 500}, {"block_bytes": 300, "hot": 3, "bucket_bytes": 2000}]


@pytest.mark.parametrize("options", SMALL)
@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, seed, options):
    rows = corpus(seed)
    assert found(substring_dedup(frame(spark, rows), 13, 4, **options)) == plain(rows, 13, True)


@pytest.mark.parametrize("options", SMALL)
@pytest.mark.parametrize("seed", [3, 4])
def test_bytes(spark, seed, options):
    rows = corpus(seed)
    options = {**options, "shard_symbols": 300} if options else options
    assert found(suffix_dedup(frame(spark, rows), 50, 16, **options)) == plain(rows, 50, False)


@pytest.mark.parametrize("dedup,size,words", [(substring_dedup, 13, True), (suffix_dedup, 50, False)])
def test_edges(spark, dedup, size, words):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [
        (5, None),
        (6, ""),
        (7, " \n\t "),
        (2, passage),
        (9, passage),
        (9, passage),  # a repeated row
        (9, "other words " + passage),  # the same id with another text
        (None, passage),
        (None, passage),
        (1, "a " * 3000),
        (3, "a " * 40),
        (-4, "\0" * 60 + passage[:49]),
        (8, "\0" * 55),
    ]
    docs = clashing(frame(spark, rows))
    assert found(dedup(docs)) == plain(rows, size, words)
    assert dedup(frame(spark, [])).count() == 0


def test_a_hot_passage_goes_by_windows(spark):
    rows = [(i, f"start{i} of it " + "the common line that all of them hold at the very same place here " * 2 + f"end {i}") for i in range(40)]
    for options in ({}, {"hot": 5, "block_bytes": 500}):
        assert found(suffix_dedup(frame(spark, rows), **options)) == plain(rows, 50, False)
        assert found(substring_dedup(frame(spark, rows), **options)) == plain(rows, 13, True)


def test_every_window_has_its_anchor_wherever_it_stands():
    r = np.random.default_rng(0)
    unit = Unit(words=False, length=50, gram=16)
    shared = r.integers(97, 100, 400).astype(np.uint64)
    texts = [np.concatenate([r.integers(97, 100, n).astype(np.uint64), shared]) for n in (0, 13, 250)]
    keys = []
    for t in texts:
        starts, ends, own, _ = anchors(t, unit, np.array([0]), np.array([len(t)]))
        per_window = np.repeat(own, ends - starts + 1)
        assert len(per_window) == len(t) - 49
        keys.append(per_window[-(400 - 49) :])
    assert (keys[0] == keys[1]).all() and (keys[0] == keys[2]).all()


def test_suffix_array_and_common_prefixes():
    r = np.random.default_rng(1)
    for n in (1, 7, 300):
        codes = np.append(r.integers(1, 4, n), 0)
        order = suffix_array(byte_heads(codes), _FIRST)
        text = [tuple(codes[i:]) for i in range(n + 1)]
        assert order.tolist() == sorted(range(n + 1), key=text.__getitem__)
        shared = common_prefixes(codes, order, np.array([0]), 1000)
        for a, b, got in zip(order, order[1:], shared[1:]):
            want = next(k for k in range(n + 1) if k >= min(len(text[a]), len(text[b])) or text[a][k] != text[b][k])
            assert got == want


def test_wavelet_tree_ranks():
    r = np.random.default_rng(2)
    values = r.integers(0, 37, 500)
    tree = WaveletTree(values, 6)
    asked = np.arange(40)
    low, high = np.full(40, 100), np.full(40, 500)
    a, b = tree.rank(asked, low, high)
    assert a.tolist() == [int((values[:100] == v).sum()) for v in asked]
    assert b.tolist() == [int((values == v).sum()) for v in asked]


def test_matching_statistics():
    r = np.random.default_rng(3)
    codes = np.concatenate([np.append(r.integers(1, 4, 30), 0) for _ in range(5)])
    index = FMIndex(codes, np.arange(len(codes)))
    query = r.integers(1, 4, 40)
    ends = np.arange(41)
    length, low, high = index.statistics(query, ends, 8)
    text = codes.tolist()
    for e, got, a, b in zip(ends, length, low, high):
        fits = [n for n in range(min(e, 8) + 1) if any(text[i : i + n] == query[e - n : e].tolist() for i in range(len(text)))]
        assert got == max(fits)
        if got:
            places = [i for i in range(len(text)) if text[i : i + got] == query[e - got : e].tolist()]
            assert b - a == len(places)
            assert index.earliest(np.array([a]), np.array([b]))[0] == min(places)
    # Words beyond those of the index are none of its.
    length, _, _ = index.statistics(np.array([1, 9, 2, 1000, 3]), np.arange(1, 6), 8)
    assert length.tolist() == [1, 0, 1, 0, 1]


@pytest.mark.parametrize("size", [1, 5, 31, 32, 33, 64, 200, 1500])
def test_least_of_any_stretch(size):
    r = np.random.default_rng(size)
    values = r.integers(-5, 1000, size) * 2**40
    low = r.integers(0, size, 400)
    high = low + 1 + r.integers(0, size - low)
    assert RangeMinimum(values).least(low, high).tolist() == [values[a:b].min() for a, b in zip(low, high)]


def test_a_suffix_array_refuses_what_it_cannot_number():
    with pytest.raises(ValueError):
        suffix_array(np.ones(1 << 20, np.uint64), 1)


def in_one_process(rows, unit, resolve, blocks=2, buckets=3, hot=2048):
    """The steps of ``remove_later_copies`` one after the other, as Spark would run them."""
    known = pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "body": pa.array([t.encode() for _, t in rows], pa.binary())})
    dealt = [known.take([k for k in range(len(rows)) if k % blocks == b]) for b in range(blocks)]
    dealt = [t.append_column("block", pa.array([b] * t.num_rows, pa.int64())) for b, t in enumerate(dealt) if t.num_rows]
    sent = pa.concat_tables([windows._sent_anchors(unit)(t) for t in dealt]).sort_by("key").combine_chunks()
    kinds = pa.schema([("block", pa.int64()), ("key", pa.int64()), ("hot", pa.bool_())])
    flagged = pa.Table.from_batches(list(windows._repeated(hot)(iter(sent.to_batches()))), schema=kinds)
    segments = []
    for b, t in enumerate(dealt):
        own = flagged.filter(pc.equal(flagged.column("block"), b))
        segments.append(windows._sent_segments(unit, buckets)(t, own))
    segments = pa.concat_tables(segments)
    spans = [
        windows._spans(unit, resolve)(own)
        for own in (segments.filter(pc.equal(segments.column("bucket"), k)) for k in range(buckets))
        if own.num_rows
    ]
    out = []
    for b, t in enumerate(dealt):
        own = [s.filter(pc.equal(s.column("block"), b)) for s in spans]
        none = pa.table({n: pa.array([], pa.binary()) for n in ("rows", "firsts", "sizes")})
        out += windows._cleaned(unit)(t, pa.concat_tables(own) if own else none).to_pylist()
    return sorted(((r["doc_id"], r["n_symbols"], r["n_removed"], len(r["spans"]), r["kept"]) for r in out), key=repr)


WORDS, BYTES = windows.Unit(True, 13, 4), windows.Unit(False, 50, 16)


def resolver(unit):
    return fm_resolver(13) if unit.words else suffix_resolver(50, 300)


@pytest.mark.parametrize("unit", [WORDS, BYTES])
@pytest.mark.parametrize("hot", [2048, 2])
@pytest.mark.parametrize("broken", ["symbols", "all"])
def test_hashes_only_route(monkeypatch, unit, hot, broken):
    """Right results where all hashes are one, or where words that differ share theirs."""
    rows = corpus(11, n=25)
    if broken == "all":
        monkeypatch.setattr(windows, "_mixed", lambda out: out * np.uint64(0))
    else:
        plain_symbols = windows.Unit.symbols
        monkeypatch.setattr(
            windows.Unit, "symbols", lambda self, text: (plain_symbols(self, text)[0] % np.uint64(3), plain_symbols(self, text)[1])
        )
    assert in_one_process(rows, unit, resolver(unit), hot=hot) == plain(rows, unit.length, unit.words)


@settings(max_examples=40, deadline=None)
@given(st.data())
def test_texts_that_differ_in_a_few_characters(data):
    """Small vocabularies, and numbers that differ in a digit or two."""
    size = data.draw(st.integers(2, 5))
    bag = data.draw(st.lists(st.sampled_from(["1234", "1243", "2134", "a", "b", "ab", "ba", "5678", "5668", "2234", "x" * 9]), min_size=size, max_size=size))
    base = data.draw(st.lists(st.sampled_from(bag), min_size=13, max_size=40))
    rows = []
    for i in range(data.draw(st.integers(2, 5))):
        own = list(base)
        for _ in range(data.draw(st.integers(0, 2))):
            at = data.draw(st.integers(0, len(own) - 1))
            digits = list(own[at])
            digits[data.draw(st.integers(0, len(digits) - 1))] = data.draw(st.sampled_from("0123ab"))
            own[at] = "".join(digits)
        rows.append((i, " ".join(own)))
    for hot in (2048, 3):
        assert in_one_process(rows, WORDS, fm_resolver(13), hot=hot) == plain(rows, 13, True)
        assert in_one_process(rows, BYTES, suffix_resolver(50, 300), hot=hot) == plain(rows, 50, False)


def test_numbers_in_two_words_make_up_for_each_other():
    text = "alpha bravo charlie delta echo foxtrot {} ms {} golf hotel india juliet"
    rows = [(1, text.format(1234, 5678)), (2, text.format(2234, 5668))]
    assert in_one_process(rows, WORDS, fm_resolver(13)) == plain(rows, 13, True)
    assert plain(rows, 13, True)[1][2] == 0


def test_long_words_that_swap_far_characters():
    def long(swap):
        word = [chr(97 + k % 26) for k in range(5000)]
        word[100], word[4196] = ("X", "Y") if swap else ("Y", "X")
        return "".join(word) + " " + " ".join(f"w{k}" for k in range(12))

    a, b = long(False), long(True)
    for rows in ([(1, a), (2, b), (3, b)], [(1, a), (2, b), (3, a)]):
        assert in_one_process(rows, WORDS, fm_resolver(13)) == plain(rows, 13, True)


def log_lines(lines, seed, shared=()):
    r = random.Random(seed)
    own = [f"GET / HTTP 200 OK in {r.randint(1000, 9999)} ms {r.randint(1000, 99999)} B" for _ in range(lines)]
    for k, line in enumerate(shared):
        own[(k * 37 + seed * 11) % lines] = line
    return "\n".join(own)


@pytest.mark.parametrize("lines", [4000, 40_000])
def test_log_lines(spark, lines):
    """Hot windows by the ten thousand, all with one anchor."""
    shared = log_lines(20, 9).split("\n")
    rows = [(n, log_lines(lines, n, shared)) for n in (1, 2)]
    assert found(substring_dedup(frame(spark, rows))) == plain(rows, 13, True)
    if lines < 10_000:
        assert found(suffix_dedup(frame(spark, rows))) == plain(rows, 50, False)


def test_the_threshold_decides():
    """Texts are searched that the index does not hold; a match of fewer words reports nothing."""
    words = [f"w{k}" for k in range(30)]
    new = [f"new{k}" for k in range(9)]
    rows = [(1, " ".join(words[:20])), (2, " ".join([*words[8:20], "other", *words[20:]])), (3, " ".join([*new, *words[3:15]]))]
    keys = lambda n: [7] * n
    segments, ids = [t.encode() for _, t in rows], [i for i, _ in rows]
    right = fm_resolver(13)(segments, ids, keys(3)).tolist()
    short = fm_resolver(13, threshold=5)(segments, ids, keys(3)).tolist()
    count = [len(s.split()) - 12 for s in segments]
    assert right == [1] * count[0] + [2] * count[1] + [3] * count[2]
    assert short != right and set(short[-count[2] :]) == {1, 3}
