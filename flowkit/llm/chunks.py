"""Texts cut at spaces into chunks that a tokenizer treats one by one, and a table of their ids."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What stands between the chunks of a text.
CUT = "\0"
#: Characters of texts that are encoded together.
TOGETHER = 4 << 20
#: Bytes of texts that a worker takes from a batch at once.
SLICE = 1 << 20


def together(texts: Sequence[str], most: int = TOGETHER) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` characters; a longer text is a run of its own or ends one."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most or i == len(texts) - 1:
            yield first, i + 1
            first, size = i + 1, 0


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of a column, which bounds what a task holds beside them.

    A worker outlives its tasks and stages, so what Arrow keeps of a slice
    that is done with goes back to the system before the next one.
    """
    pool = pa.default_memory_pool()
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = int(sizes[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, before + most)))
            yield batch.slice(first, last - first)
            pool.release_unused()
            first = last


def cut_up(texts: Sequence[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct chunks of all texts, the number of each chunk one text after the other, and how many a text has.

    A text is its chunks with ``CUT`` between them, or empty.
    """
    counts = np.array([t.count(CUT) + 1 if t else 0 for t in texts], np.int64)
    if not counts.any():
        return pa.array([], pa.large_string()), np.empty(0, np.int64), counts
    joined = pa.array([CUT.join(t for t in texts if t)], pa.large_string())
    chunks = pc.split_pattern(joined, CUT).flatten().dictionary_encode()
    return chunks.dictionary, chunks.indices.to_numpy().astype(np.int64), counts


def gather(flat: np.ndarray, starts: np.ndarray, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one behind the other and how many each has, from the ids of chunks and where those of each start."""
    lists = pa.LargeListArray.from_arrays(pa.array(starts), pa.array(flat))
    ends = np.concatenate([[0], np.cumsum(starts[numbers + 1] - starts[numbers])])
    cuts = np.concatenate([[0], np.cumsum(counts)])
    return lists.take(pa.array(numbers)).flatten().to_numpy(), np.diff(ends[cuts])


class ChunkTable(dict):
    """Numbers distinct chunks and keeps the ids of each.

    ``encode`` gets the new chunks and returns the ids of all of them, one
    behind the other, and how many each has. A table of more than ``limit``
    chunks, or of chunks and ids of more than ``limit_bytes``, is started anew
    before the next texts, which bounds its memory and changes no result.
    """

    def __init__(
        self,
        encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]],
        limit: int = 600_000,
        limit_bytes: int = 64 << 20,
    ):
        super().__init__()
        self._encode, self._limit, self._limit_bytes = encode, limit, limit_bytes
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self._flat = np.empty(0, np.int32)
        self._starts = np.zeros(1, np.int64)
        self._bytes = 0

    def _numbers(self, chunks: pa.Array) -> np.ndarray:
        """The numbers of distinct chunks, after new ones have been learned."""
        listed = chunks.to_pylist()
        numbers = np.fromiter(map(self.get, listed, repeat(-1)), np.int64, len(listed))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            first, unknown = len(self), chunks.take(pa.array(new))
            numbers[new] = np.arange(first, first + len(new))
            self.update(zip([listed[i] for i in new.tolist()], range(first, first + len(new))))
            flat, sizes = self._encode(unknown)
            self._flat = np.concatenate([self._flat, flat.astype(np.int32)])
            self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes)])
            self._bytes += unknown.nbytes + flat.nbytes
        return numbers

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one behind the other, and how many each has; see ``cut_up`` for the texts."""
        if len(self) > self._limit or self._bytes > self._limit_bytes:
            self._reset()
        chunks, at, counts = cut_up(texts)
        # Only the distinct chunks of these texts are looked up.
        numbers = self._numbers(chunks)[at]
        return gather(self._flat, self._starts, numbers, counts)
