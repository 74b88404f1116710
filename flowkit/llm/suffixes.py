"""Removal of repeated byte strings by suffix arrays of shards."""

from __future__ import annotations

from itertools import combinations, groupby

import numpy as np
from pyspark.sql import DataFrame

from flowkit.llm.windows import BLOCK_BYTES, BUCKET_BYTES, HOT, SHARD_SYMBOLS, Unit, remove_later_copies

#: Codes that the first sort looks at.
_FIRST = 4
#: Codes that are compared at once.
_STRIDE = 7
_BITS = np.uint64(20)
_LOW = np.uint64((1 << 20) - 1)


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys with the place in the low bits: the places, and where groups of equal keys start."""
    high = keys >> _BITS
    return (keys & _LOW).astype(np.int64), np.concatenate([[True], high[1:] != high[:-1]])


def suffix_array(heads: np.ndarray, have: int) -> np.ndarray:
    """Places in the order of their suffixes, after Larsson and Sadakane.

    ``heads`` (below 2**44, fewer than 2**20 of them) order the first ``have``
    symbols from each place. Suffixes that agree so far are ranked by the last
    place of their group; a round sorts only the groups of more than one, by
    the ranks of what follows, and so doubles the length that is in order.
    """
    n = len(heads)
    if not n:
        return np.empty(0, np.int64)
    if n >= 1 << int(_BITS):
        raise ValueError(f"{n} codes; a suffix array takes fewer than {1 << int(_BITS)}")
    order, new = _ranked(np.sort((heads << _BITS) | np.arange(n, dtype=np.uint64)))
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, n))
    rank = np.zeros(n + 1, np.uint64)
    rank[order] = np.repeat((starts + sizes).astype(np.uint64), sizes)
    open_at = np.flatnonzero(np.repeat(sizes > 1, sizes))
    while len(open_at):
        places = order[open_at]
        after = rank[np.minimum(places + have, n)]
        # Groups keep their place: the rank so far is the major key.
        keys = (rank[places] << (_BITS + _BITS)) | (after << _BITS) | places.astype(np.uint64)
        places, new = _ranked(np.sort(keys))
        order[open_at] = places
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(places)))
        rank[places] = np.repeat(open_at[starts + sizes - 1].astype(np.uint64) + np.uint64(1), sizes)
        open_at = open_at[np.repeat(sizes > 1, sizes)]
        have *= 2
    return order


def byte_heads(codes: np.ndarray) -> np.ndarray:
    """The first four codes from each place; a code takes nine bits."""
    padded = np.concatenate([codes.astype(np.uint64), np.zeros(_FIRST, np.uint64)])
    heads = np.zeros(len(codes), np.uint64)
    for i in range(_FIRST):
        heads = (heads << np.uint64(9)) | padded[i : i + len(codes)]
    return heads


def common_prefixes(codes: np.ndarray, order: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """For each place in the order, how much it shares with the one before it, up to ``depth``.

    After Kasai: a suffix shares at least one code less with its predecessor
    than the suffix that starts one place earlier. The segments that begin at
    ``starts`` are walked side by side, so one step serves all of them.
    """
    n = len(codes)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    # Seven codes to a number; behind the end stands a code that no text has.
    padded = np.concatenate([codes.astype(np.uint64), np.full(depth + _STRIDE, 511, np.uint64)])
    words = np.zeros(n + depth, np.uint64)
    for k in range(_STRIDE):
        words = (words << np.uint64(9)) | padded[k : k + n + depth]
    shared = np.zeros(n, np.int64)
    at = starts.astype(np.int64)
    ends = np.append(starts[1:], n)
    have = np.zeros(len(starts), np.int64)
    while len(at):
        mine, other = at, before[at]
        length = np.where(other >= 0, np.maximum(have - 1, 0), depth)
        going = np.flatnonzero(length < depth)
        a, b = (mine + length)[going], (other + length)[going]
        while len(going):
            same = _equal_codes(words[a] ^ words[b])
            length[going] += same
            more = np.flatnonzero((same == _STRIDE) & (length[going] < depth))
            going, a, b = going[more], a[more] + _STRIDE, b[more] + _STRIDE
        have = np.where(other >= 0, np.minimum(length, depth), 0)
        shared[at] = have
        at = at + 1
        left = at < ends
        if not left.all():
            at, ends, have = at[left], ends[left], have[left]
    return shared[order]


def _equal_codes(differ: np.ndarray) -> np.ndarray:
    """Codes of nine bits that agree from the top, from what differs."""
    for shift in (1, 2, 4, 8, 16, 32):
        differ = differ | (differ >> np.uint64(shift))
    return (63 - np.bitwise_count(differ).astype(np.int64)) // 9


class _Shard:
    """The suffix array of some segments: their windows in order, and the earliest document of each."""

    def __init__(self, segments: list[bytes], ids: list[int], window: int):
        self.window = window
        self.text = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
        sizes = np.array([len(s) for s in segments])
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        codes = self.text.astype(np.uint16) + np.uint16(1)
        codes[self.starts + sizes] = 0  # an end is no byte of a text
        order = suffix_array(byte_heads(codes), _FIRST)
        shared = common_prefixes(codes, order, self.starts, window)
        owner = np.repeat(np.arange(len(segments)), sizes + 1)
        valid = order - self.starts[owner[order]] + window <= sizes[owner[order]]
        # Between two equal windows stand only windows equal to them.
        new = (shared < window)[valid]
        self.order = order[valid]
        self.group = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        self.heads = self.order[heads]
        self.early = np.minimum.reduceat(np.array(ids, np.int64)[owner[self.order]], heads)
        self.sizes = sizes

    def merge(self, other: _Shard, mine: slice, theirs: slice) -> None:
        """Give windows that both have, in the named segments, the earlier document of the two."""
        a, b = self._windows(mine), other._windows(theirs)
        if not len(a[0]) or not len(b[0]):
            return
        at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
        both = b[0][at] == a[0]
        left, right = a[1][both], b[1][at[both]]
        least = np.minimum(self.early[left], other.early[right])
        self.early[left], other.early[right] = least, least

    def _windows(self, segments: slice) -> tuple[np.ndarray, np.ndarray]:
        """The distinct windows of some segments, in order, as fixed-width strings, and their groups."""
        first = self.starts[segments.start]
        last = self.starts[segments.stop - 1] + self.sizes[segments.stop - 1]
        inside = np.flatnonzero((self.order >= first) & (self.order < last))
        groups = self.group[inside]
        groups = groups[np.concatenate([[True], groups[1:] != groups[:-1]])] if len(groups) else groups
        rows = np.lib.stride_tricks.sliding_window_view(self.text, self.window)[self.heads[groups]]
        return np.ascontiguousarray(rows).view(f"S{self.window}").ravel(), groups

    def firsts(self) -> np.ndarray:
        """The earliest document of every window, by place."""
        return self.early[self.group][np.argsort(self.order)]


def suffix_resolver(window: int, shard_symbols: int = SHARD_SYMBOLS):
    """Earliest documents of windows by suffix arrays; keys that straddle shards are merged by binary search.

    Shards end between keys where they can. A key has as many segments as its
    anchor has places at most, so only few shards ever hold parts of one.
    """

    def resolve(segments: list[bytes], ids: list[int], keys: list[int]) -> np.ndarray:
        cuts, size = [0], 0
        for i, s in enumerate(segments):
            full = size + len(s) + 1 > shard_symbols
            if size and (full or size > shard_symbols // 2 and keys[i] != keys[i - 1]):
                cuts.append(i)
                size = 0
            size += len(s) + 1
        cuts.append(len(segments))
        shards = [_Shard(segments[a:b], ids[a:b], window) for a, b in zip(cuts, cuts[1:])]
        # The runs of each key, by shard; the keys come sorted.
        runs: dict[int, list[tuple[int, slice]]] = {}
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            for key, run in groupby(range(a, b), key=keys.__getitem__):
                own = list(run)
                runs.setdefault(key, []).append((n, slice(own[0] - a, own[-1] - a + 1)))
        for pieces in runs.values():
            # Each pair meets once, in order; the last to meet has heard of all.
            for (i, mine), (j, theirs) in combinations(pieces, 2):
                shards[i].merge(shards[j], mine, theirs)
        return np.concatenate([s.firsts() for s in shards])

    return resolve


def suffix_dedup(
    docs: DataFrame,
    window: int = 50,
    gram: int = 16,
    hot: int = HOT,
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = 3 * BUCKET_BYTES // 2,
    shard_symbols: int = SHARD_SYMBOLS,
) -> DataFrame:
    """Remove each byte covered by a ``window``-byte string that also starts in an earlier document.

    Texts count as UTF-8; see ``windows.remove_later_copies`` for the columns
    and for NULLs. Strings that may be shared meet in buckets, each cut into
    shards of about ``shard_symbols`` bytes. In a shard a suffix array
    (Larsson and Sadakane) and common prefixes (Kasai) bring equal strings
    together; where a shard ends among segments that may hold the same string,
    the strings of one shard are looked up in the next by binary search.
    """
    unit = Unit(words=False, length=window, gram=gram)
    return remove_later_copies(docs, unit, suffix_resolver(window, shard_symbols), hot, block_bytes, bucket_bytes)
