"""Removal of repeated runs of words by FM-indexes of shards."""

from __future__ import annotations

from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame

from flowkit.llm.suffixes import suffix_array
from flowkit.llm.windows import BLOCK_BYTES, BUCKET_BYTES, HOT, Unit, remove_later_copies

#: An index covers fewer than 2**20 words; a word takes two bytes at least.
_INDEX_BYTES = 3 << 18
#: Places of a block of a range minimum.
_SPAN = 32


class WaveletTree:
    """A sequence of numbers as bit planes, which counts a number in any prefix.

    Level by level, numbers are sorted stably by their bits from the top; a
    plane holds one bit each, with the number of ones before every 64 bits.
    """

    def __init__(self, values: np.ndarray, bits: int):
        self.bits = bits
        self.planes: list[np.ndarray] = []
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        values = values.astype(np.uint32)
        for level in range(bits - 1, -1, -1):
            bit = ((values >> np.uint32(level)) & np.uint32(1)).astype(bool)
            words = -(-(len(bit) + 1) // 64)
            packed = np.zeros(words * 8, np.uint8)
            packed[: -(-len(bit) // 8)] = np.packbits(bit, bitorder="little")
            plane = packed.view(np.uint64)
            self.planes.append(plane)
            counts = np.cumsum(np.bitwise_count(plane), dtype=np.int64)
            self.ones.append(np.concatenate([[0], counts[:-1]]))
            self.zeros.append(len(bit) - int(counts[-1]) if len(counts) else 0)
            values = np.concatenate([values[~bit], values[bit]])

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.planes[level][word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.ones[level][word] + np.bitwise_count(below)

    def _down(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Follow places from plane to plane along the bits of their values."""
        for level in range(self.bits):
            one = (values >> (self.bits - 1 - level)) & 1 == 1
            ones = self._rank(level, at)
            at = np.where(one, self.zeros[level] + ones, at - ones)
        return at

    @cached_property
    def _begin(self) -> np.ndarray:
        """Where each value starts behind the last plane."""
        values = np.arange(1 << self.bits)
        return self._down(values, np.zeros(len(values), np.int64))

    def rank(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each value stands before ``low`` and before ``high``."""
        down = self._down(np.concatenate([values, values]), np.concatenate([low, high]))
        begin = self._begin[values]
        return down[: len(values)] - begin, down[len(values) :] - begin


class RangeMinimum:
    """The least of any stretch of numbers.

    Kept are the ranks of the numbers, the least from either end of every
    block of 32 to each place, and a table of the least of 2**j blocks.
    """

    def __init__(self, values: np.ndarray):
        self.values, ranks = np.unique(values, return_inverse=True)
        size = -(-len(values) // _SPAN)
        blocks = np.full(size * _SPAN, len(self.values), np.int32)
        blocks[: len(values)] = ranks
        blocks = blocks.reshape(-1, _SPAN)
        self.ranks = blocks.ravel()
        self.ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        self.behind = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
        self.table = [blocks.min(1)]
        while 2 << (len(self.table) - 1) <= size:
            last, step = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-step], last[step:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least of each stretch from ``low`` to ``high`` (exclusive), which is not empty."""
        first, last = low // _SPAN, (high - 1) // _SPAN
        out = np.minimum(self.behind[low], self.ahead[high - 1])
        near = np.flatnonzero(first == last)
        if len(near):
            out[near] = self.ranks[low[near]]
            for step in range(1, int((high - low)[near].max())):
                near = near[low[near] + step < high[near]]
                out[near] = np.minimum(out[near], self.ranks[low[near] + step])
        blocks = last - first - 1
        level = np.frexp(np.maximum(blocks, 1).astype(np.float64))[1] - 1
        for j in np.unique(level[blocks > 0]).tolist():
            at = np.flatnonzero((blocks > 0) & (level == j))
            own = np.minimum(self.table[j][first[at] + 1], self.table[j][last[at] - (1 << j)])
            out[at] = np.minimum(out[at], own)
        return self.values[out]


class FMIndex:
    """Backward search in segments of words, which are numbered from 1; 0 ends a segment."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray):
        """``codes`` holds the segments, each with a 0 behind it, ``ids`` the document of each place."""
        n = len(codes)
        # Ends differ from each other by their place, so the order is one of whole suffixes.
        end = codes == 0
        heads = codes + int(end.sum())
        heads[end] = np.arange(int(end.sum()))
        order = suffix_array(heads.astype(np.uint64), 1)
        bits = max(1, int(codes.max()).bit_length())
        self.tree = WaveletTree(codes[order - 1], bits)
        counts = np.bincount(codes, minlength=1 << bits)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.size = n
        self.documents = RangeMinimum(ids[order])

    def statistics(self, codes: np.ndarray, ends: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the words before each end, the longest run (up to ``limit``) that the index holds.

        Returns its length and its interval of suffixes, found by backward
        search for all ends side by side. Numbers beyond those of the index
        are words that it does not hold.
        """
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.size, np.int64)
        length = np.zeros(len(ends), np.int64)
        going = np.flatnonzero(ends > 0)
        for step in range(limit):
            going = going[ends[going] - step > 0]
            word = codes[ends[going] - 1 - step]
            held = (word > 0) & (word < len(self.before) - 1)
            going, word = going[held], word[held]
            if not len(going):
                break
            if step:
                first, last = self.tree.rank(word, low[going], high[going])
                first, last = self.before[word] + first, self.before[word] + last
            else:
                first, last = self.before[word], self.before[word + 1]
            found = first < last
            going = going[found]
            low[going], high[going] = first[found], last[found]
            length[going] = step + 1
        return length, low, high

    def earliest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least document in each interval."""
        return self.documents.least(low, high)


def fm_resolver(window: int, threshold: int | None = None):
    """Earliest documents of windows of words by FM-indexes of some segments, against which all are searched.

    A window that a segment shares with no earlier document has the
    segment's own one. The segment of a key that comes last, by its earliest
    document, is none that others could have copied, so the index goes
    without it. Matches shorter than ``threshold`` words (``window``) report
    nothing.
    """
    enough = window if threshold is None else threshold

    def resolve(segments: list[bytes], ids: list[int], keys: list[int]) -> np.ndarray:
        parts = _whole_keys(segments, keys)
        return np.concatenate([earliest(segments[a:b], ids[a:b], keys[a:b]) for a, b in parts])

    def earliest(segments: list[bytes], ids: list[int], keys: list[int]) -> np.ndarray:
        documents = np.array(ids, np.int64)
        order = np.lexsort((documents, np.array(keys, np.uint64)))
        sorted_keys = np.array(keys, np.uint64)[order]
        indexed = np.zeros(len(order), bool)
        indexed[order] = np.append(sorted_keys[1:] == sorted_keys[:-1], False)
        # Words of the index have the lowest numbers.
        number: dict[bytes, int] = {}
        coded: list[list[int]] = [[]] * len(segments)
        for i in [*np.flatnonzero(indexed).tolist(), *np.flatnonzero(~indexed).tolist()]:
            coded[i] = [number.setdefault(w, len(number) + 1) for w in segments[i].split(b" ")]
        sizes = np.array([len(c) for c in coded])
        codes = np.array([n for c in coded for n in (*c, 0)], np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes + 1)
        within = np.arange(len(codes)) - np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes + 1)
        ends = np.flatnonzero((within >= window) & (within <= sizes[owner]))
        out = documents[owner[ends]]
        held = indexed[owner]
        if held.any():
            index = FMIndex(codes[held], documents[owner[held]])
            length, low, high = index.statistics(codes, ends, window)
            hit = np.flatnonzero(length >= enough)
            out[hit] = np.minimum(out[hit], index.earliest(low[hit], high[hit]))
        return out

    return resolve


def _whole_keys(segments: list[bytes], keys: list[int]) -> list[tuple[int, int]]:
    """Cut the segments between keys into runs that one index can cover."""
    cuts, size = [0], 0
    for i, s in enumerate(segments):
        if size > _INDEX_BYTES and keys[i] != keys[i - 1]:
            cuts.append(i)
            size = 0
        size += len(s) + 1
    return list(zip(cuts, [*cuts[1:], len(segments)]))


def substring_dedup(
    docs: DataFrame,
    window: int = 13,
    gram: int = 4,
    hot: int = HOT,
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Remove each word covered by a run of ``window`` words that also starts in an earlier document.

    Words are runs of other bytes than ASCII white space. See
    ``windows.remove_later_copies`` for the columns and for NULLs. Runs that
    may be shared meet in buckets; an FM-index (wavelet tree over the
    Burrows-Wheeler transform) of those that others may have copied gives the
    matching statistics of all the bucket's texts, and those of ``window``
    words are reported with the earliest document of their interval.
    """
    unit = Unit(words=True, length=window, gram=gram)
    return remove_later_copies(docs, unit, fm_resolver(window), hot, block_bytes, bucket_bytes)
