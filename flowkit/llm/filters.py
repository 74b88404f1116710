"""Counting quotient filters over permuted word-id n-grams, without loss."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Keys of the rounds that permute; any odd numbers do.
_ROUNDS = tuple(np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
_SMALL = 255


def _mixed(values: np.ndarray, key: np.uint64, half: int) -> np.ndarray:
    out = (values + key) * np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xC4CEB9FE1A85EC53)
    return out >> np.uint64(64 - half)


@dataclass(frozen=True)
class Packing:
    """How ``n`` (2 or 3) word ids of ``width`` bits become two halves of one number, and back.

    The halves are permuted by a Feistel network, which can be undone whatever
    its rounds compute: equal n-grams get equal numbers, different ones never
    do, and the numbers spread evenly.
    """

    n: int
    width: int

    @property
    def half(self) -> int:
        """Bits of a half."""
        return -(-self.n * self.width // 2)

    def pack(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        w, own = np.uint64(self.width), [i.astype(np.uint64) for i in ids]
        if self.n == 2:
            left, right = own
        else:
            # The middle id is cut between the halves.
            low = np.uint64(self.half - self.width)
            right = own[2] | ((own[1] & ((np.uint64(1) << low) - np.uint64(1))) << w)
            left = (own[0] << (w - low)) | (own[1] >> low)
        for key in _ROUNDS:
            left, right = right, left ^ _mixed(right, key, self.half)
        return left, right

    def unpack(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        for key in reversed(_ROUNDS):
            left, right = right ^ _mixed(left, key, self.half), left
        if self.n == 2:
            return [left.astype(np.int64), right.astype(np.int64)]
        w, low = np.uint64(self.width), np.uint64(self.half - self.width)
        last = right & ((np.uint64(1) << w) - np.uint64(1))
        middle = (right >> w) | ((left & ((np.uint64(1) << (w - low)) - np.uint64(1))) << low)
        return [x.astype(np.int64) for x in (left >> (w - low), middle, last)]


def counted(left: np.ndarray, right: np.ndarray, counts: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers in order, each once, with the sum of its counts.

    Filters put one behind the other are runs in order, which the stable sort merges.
    """
    if not len(left):
        return left, right, counts
    if 2 * half <= 64:
        order = np.argsort((left << np.uint64(half)) | right, kind="stable")
    else:
        order = np.lexsort((right, left))
    left, right = left[order], right[order]
    at = np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
    return left[at], right[at], np.add.reduceat(counts[order], at)


def _planes(values: np.ndarray, bits: int) -> bytes:
    """The lowest ``bits`` of numbers, a byte of all of them after the other."""
    return b"".join((values >> np.uint64(8 * k)).astype(np.uint8).tobytes() for k in range(-(-bits // 8)))


def _from_planes(raw: bytes, at: int, count: int, bits: int) -> tuple[np.ndarray, int]:
    out = np.zeros(count, np.uint64)
    for k in range(-(-bits // 8)):
        out |= np.frombuffer(raw, np.uint8, count, at).astype(np.uint64) << np.uint64(8 * k)
        at += count
    return out, at


def _bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask, bitorder="little").tobytes()


def _from_bits(raw: bytes, at: int, count: int) -> tuple[np.ndarray, int]:
    size = -(-count // 8)
    return np.unpackbits(np.frombuffer(raw, np.uint8, size, at), count=count, bitorder="little").astype(bool), at + size


def encode(left: np.ndarray, right: np.ndarray, counts: np.ndarray, half: int, skip: int) -> bytes:
    """A filter of numbers in order that agree in their first ``skip`` bits.

    The next bits are the quotient, as many as give each number a slot. One
    bit for every quotient says whether it is taken, one for every slot
    whether its run ends there; the slots hold the whole remainders, and a
    byte counts up to 254, larger counts follow.
    """
    size = len(left)
    q = min(half - skip, max(0, size - 1).bit_length())
    rest = half - skip - q
    quotient = ((left >> np.uint64(rest)) & np.uint64((1 << q) - 1)).astype(np.int64)
    taken = np.zeros(1 << q, bool)
    taken[quotient] = True
    ends = np.concatenate([quotient[1:] != quotient[:-1], [True]])[:size]
    many = counts[counts >= _SMALL]
    head = np.array([size, q, half, skip, len(many)], "<u4").tobytes()
    low = left & np.uint64((1 << rest) - 1)
    small = np.minimum(counts, _SMALL).astype(np.uint8).tobytes()
    return b"".join(
        [head, _bits(taken), _bits(ends), _planes(low, rest), _planes(right, half), small, many.astype("<i8").tobytes()]
    )


def decode(raw: bytes, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers and counts of a filter whose first bits are ``prefix``."""
    size, q, half, skip, many = (int(x) for x in np.frombuffer(raw, "<u4", 5))
    rest = half - skip - q
    taken, at = _from_bits(raw, 20, 1 << q)
    ends, at = _from_bits(raw, at, size)
    low, at = _from_planes(raw, at, size, rest)
    right, at = _from_planes(raw, at, size, half)
    counts = np.frombuffer(raw, np.uint8, size, at).astype(np.int64)
    counts[counts == _SMALL] = np.frombuffer(raw, "<i8", many, at + size)
    run = np.concatenate([[0], np.cumsum(ends)[:-1]]).astype(np.int64)[:size]
    quotient = np.flatnonzero(taken)[run].astype(np.uint64)
    left = (np.uint64(prefix) << np.uint64(half - skip)) | (quotient << np.uint64(rest)) | low
    return left, right, counts


def merged(filters: list[tuple[bytes, int]], half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers of several filters, each given with its prefix, and the sums of their counts."""
    parts = [decode(raw, prefix) for raw, prefix in filters]
    return counted(*(np.concatenate(x) for x in zip(*parts)), half)


def split(
    left: np.ndarray, right: np.ndarray, counts: np.ndarray, half: int, skip: int
) -> tuple[list[int], list[int], list[bytes]]:
    """Filters of numbers in order, one for each prefix of ``skip`` bits: prefixes, sizes and filters."""
    prefix = (left >> np.uint64(half - skip)).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]])[: len(prefix)])
    ends = np.append(cuts[1:], len(prefix)).astype(np.int64)
    spans = list(zip(cuts.tolist(), ends.tolist()))
    filters = [encode(left[a:b], right[a:b], counts[a:b], half, skip) for a, b in spans]
    return prefix[cuts].tolist(), [b - a for a, b in spans], filters
