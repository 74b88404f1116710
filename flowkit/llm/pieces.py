"""SentencePiece encoding and decoding by a table of distinct marked words."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowkit.llm.chunks import CUT, ChunkTable, slices

_MARK = "▁"
_SPACES = re.compile(r"^[^ ]+| +[^ ]*")
#: Distinct words, and bytes of them and their ids, at which the table is started anew.
_WORDS, _WORDS_BYTES = 150_000, 16 << 20


class PieceCoder:
    """Encodes and decodes as the library does, each distinct marked word once.

    A marked word is a run of spaces with the word behind it. If no piece has
    a whitespace marker behind another character, no merge crosses the start of a marked
    word, so its pieces do not depend on its neighbours. A model of which that
    is not true, or that changes spaces itself, is asked for whole texts, and
    so is a text that holds the marker or a zero character.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        crossing = any(_MARK in p.lstrip(_MARK) for p in pieces if not self.model.is_control(self.model.piece_to_id(p)))
        # A line break that stands in no longer piece is a word of its own.
        self.lines = not any("\n" in p and len(p) > 1 for p in pieces)
        probes = ("a", " a", "a  b", "a ", "  a  b c", "a\n b")
        kept = all(self.model.decode(self.model.encode(x)) == x for x in probes)
        self.mark = self.model.piece_to_id(_MARK)
        self.by_word = not crossing and kept and self.model.encode(" ") != self.model.encode("")
        self.table = ChunkTable(self._encode, _WORDS, _WORDS_BYTES)

    def _encode(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = chunks.to_pylist()
        # The library puts a marker before a text, which stands for the first space.
        ids = self.model.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        for i, word in enumerate(words):
            if word == " ":
                ids[i] = [self.mark]
            elif word[0] == "\n":
                if ids[i][0] != self.mark:
                    raise ValueError("the marker before a line break is not a piece of its own")
                ids[i] = ids[i][1:]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes

    def _words(self, text: str) -> str | None:
        """The text cut into marked words, or None if it is to be encoded whole."""
        if not self.by_word or _MARK in text or CUT in text:
            return None
        if not text:
            return ""
        text = f" {text}"
        if "  " not in text:
            cut = text.replace(" ", "\0 ")
        else:
            cut = CUT + CUT.join(_SPACES.findall(text))
        if self.lines:
            cut = cut.replace("\n", "\0\n")
        return cut[1:]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, with those of its begin and end."""
        begin, end = self.model.bos_id(), self.model.eos_id()
        cut = [self._words(t) for t in texts]
        ids, sizes = self.table.ids([c or "" for c in cut])
        parts = np.split(ids, np.cumsum(sizes)[:-1]) if len(texts) else []
        out = []
        for text, words, own in zip(texts, cut, parts):
            if words is None:
                own = np.array(self.model.encode(text, num_threads=1), np.int32)
            out.append(np.concatenate([[begin], own, [end]]).astype("<u4"))
        return out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return [self.model.decode(i.tolist()) for i in ids]


@lru_cache(maxsize=2)
def _coder(path: str) -> PieceCoder:
    return PieceCoder(path)


def _encoded(path: str, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for batch in slices(batches, "text"):
            ids = coder.encode(batch.column("text").to_pylist())
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(i) for i in ids])]), pa.int32())
            flat = pa.array(np.concatenate(ids).astype(np.int32))
            columns = [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, flat)]
            if decoded:
                columns.append(pa.array(coder.decode(ids), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"][: len(columns)])

    return run


def _plain(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def encode_pieces(docs: DataFrame, model: str, decoded: bool = False) -> DataFrame:
    """``doc_id`` and ``ids``, with begin and end, of each row; a NULL text counts as empty.

    With ``decoded`` also ``text``, what the ids decode to.

    ``model`` is a path that every executor can open.
    """
    return _plain(docs).mapInArrow(
        _encoded(model, decoded), "doc_id long, ids array<int>" + ", text string" * decoded
    )


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows ``doc_id``, ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model)
        for batch in batches:
            texts = [coder.model.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def piece_digests(docs: DataFrame, model: str) -> DataFrame:
    """Encode each row and decode it again: ``doc_id``, ``n_tokens`` and digests of ids and text.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers,
    ``decoded_sha256`` over the decoded text in UTF-8. Rows with a NULL id and
    repeated ones come back like any other; texts are not moved.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model)
        for batch in slices(batches, "text"):
            ids = coder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in ids]),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in coder.decode(ids)]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _plain(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
