"""Tokens against the libraries, and the wavelet matrix against plain arrays."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from flowkit.llm.chunks import SLICE, ChunkTable, slices, together
from flowkit.llm.pieces import PieceCoder, _coder, _encoded, decode_pieces, encode_pieces, piece_digests
from flowkit.llm.tokens import ByteCoder, WaveletMatrix, token_files
from tests.llm.helpers import clashing, corpus, frame

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "",
    " ",
    "  ",
    "\n",
    "\n\n\n",
    " a",
    "a ",
    "a  b",
    "a \n b\n\nc\n",
    "\ta\t b \t\tc",
    "don't I'll 'sa they've",
    "x\u00a0y \u00a0z\u2003w",
    "naïve Ärger 12345 3.14 #$%",
    "漢字 かな 한글 ไทย 𝔘𝔫𝔦 👩‍👩‍👧",
    "a<|endoftext|>b",
    "<s> </s> <unk> <0x0A>",
    "▁ a▁b ▁▁",
    "zero\0byte",
    "line\r\nline\rline",
    "ǅ ß ﬁ İ e\u0301",
    "line \n \n  \nbreaks\n\n x  \n",
    "\n\nfirst \n",
    "long " * 500 + "x" * 5000,
    *[t for _, t in corpus(21, 30)],
]


def test_byte_ids_are_those_of_the_library():
    library, coder = Tokenizer.from_file(BYTES), ByteCoder(BYTES)
    assert coder.by_rank
    for t, got in zip(TEXTS, coder.encode(TEXTS)):
        assert got.tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
    assert coder.encode([]) == [] and [len(i) for i in coder.encode(["", ""])] == [0, 0]


SPACES = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u3000", "\ufeff", "\u200b"]
OTHERS = ["a", "Zz", "'s", "\u2019", "é", "ß", "1", "½", "ª", "#", "...", "ⅷ", "漢", "😀", "<|", "|>", "ɏ", "ʰ", "\u0301", "€", "\0", "\xad"]


def test_byte_ids_of_any_mixture():
    coder, r = ByteCoder(BYTES), random.Random(4)
    few = [" ", " ", "\n"]
    texts = [
        "".join(r.choice(r.choice([SPACES, few]) if r.random() < 0.5 else OTHERS) for _ in range(r.randint(1, 9)))
        for _ in range(8000)
    ]
    for t, got in zip(texts, coder.encode(texts)):
        want = coder.library.encode(t, add_special_tokens=False).ids
        assert got.tolist() == want == coder.merger.encode_ordinary(t), repr(t)


@pytest.mark.parametrize("text", [" " * 5000 + "a", "\n \t" * 3000 + "b", "a " + "\n" * 1200, "x" * 30_000, "ab1 " * 9000])
def test_long_runs(text):
    """Runs of white space that the cutter of the merger would break down at."""
    coder = ByteCoder(BYTES)
    assert coder._plain([text]) == [text[0] == "x" or text[:3] == "ab1"]
    assert coder.encode([text])[0].tolist() == coder.library.encode(text, add_special_tokens=False).ids


def test_pieces_are_those_of_the_library():
    library, coder = sentencepiece.SentencePieceProcessor(model_file=PIECES), PieceCoder(PIECES)
    assert coder.by_word
    for _ in range(2):
        ids = coder.encode(TEXTS)
        for t, got, back in zip(TEXTS, ids, coder.decode(ids)):
            want = library.encode(t, add_bos=True, add_eos=True)
            assert got.tolist() == want, repr(t)
            assert back == library.decode(want)


@pytest.mark.parametrize("limits", [{"limit": 3}, {"limit_bytes": 10}, {}])
def test_a_full_table_starts_anew(limits):
    def encode(new):
        flat = [x for c in new.to_pylist() for x in (len(c), 1)]
        return np.array(flat), np.full(len(new), 2)

    table = ChunkTable(encode, **limits)
    for _ in range(5):
        ids, sizes = table.ids(["a\0bb", "", "ccc\0odd\0a", "d" * 4])
        assert ids.tolist() == [1, 1, 2, 1, 3, 1, 3, 1, 1, 1, 4, 1]
        assert sizes.tolist() == [4, 0, 6, 2]
    assert table.ids(["", ""])[1].tolist() == [0, 0] and len(table.ids([])[0]) == 0


def test_runs_of_texts():
    texts = ["a" * n for n in (3, 0, 9, 2, 2, 2, 1)]
    assert list(together(texts, 5)) == [(0, 3), (3, 6), (6, 7)]
    assert list(together([])) == []


def test_slices_of_batches():
    texts = ["a" * n if n is not None else None for n in (3, 0, None, 9, 2, 2, 2, 1)]
    batches = [pa.RecordBatch.from_arrays([pa.array(t, pa.string())], names=["text"]) for t in (texts, [], texts[3:])]
    cut = [b.column(0).to_pylist() for b in slices(iter(batches), "text", 5)]
    assert [x for b in cut for x in b] == texts + texts[3:]
    assert all(len(b) == 1 or sum(len(x or "") for x in b) <= 5 for b in cut) and len(cut) == 7


def test_a_large_batch_is_encoded_in_slices():
    # Distinct words: with their ids a worker would hold many times the texts.
    texts = [" ".join(f"{n * 7919 % 1000003:08x}" for n in range(i, i + 1000)) for i in range(0, 300_000, 1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts)], names=["doc_id", "text"])
    back, in_table = [], []
    for out in _encoded(PIECES, True)(iter([batch])):
        assert out.column("text").nbytes < 1.1 * SLICE
        back += zip(out.column("doc_id").to_pylist(), out.column("text").to_pylist())
        in_table.append(len(_coder(PIECES).table))
    assert back == list(enumerate(texts))
    assert max(in_table) < 150_000 + SLICE / 9


ROWS = [*[(i * 3 % 101, t) for i, t in enumerate(TEXTS)], (500, None), (None, "no id"), (500, "same id"), (500, "same id")]


def test_piece_queries(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = clashing(frame(spark, ROWS))
    want = []
    for i, t in ROWS:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((i, len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(repr, (tuple(r) for r in piece_digests(docs, PIECES).collect()))) == sorted(map(repr, want))
    encoded = encode_pieces(docs, PIECES)
    texts = sorted(repr((r.doc_id, r.text)) for r in decode_pieces(encoded, PIECES).collect())
    assert texts == sorted(repr((r.doc_id, r.text)) for r in encode_pieces(docs, PIECES, True).collect())
    assert piece_digests(frame(spark, []), PIECES).count() == 0


@pytest.mark.parametrize("shard_ids", [1 << 20, 50, 1])
def test_token_files(spark, shard_ids):
    library = Tokenizer.from_file(BYTES)
    got = token_files(clashing(frame(spark, ROWS)), BYTES, shard_ids=shard_ids).collect()
    assert len(got) == len(ROWS)
    at, own = 0, {}
    for i, t in ROWS:
        ids = np.append(library.encode(t or "", add_special_tokens=False).ids, 0).astype("<u4")
        own.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        own[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    assert token_files(frame(spark, []), BYTES).count() == 0


@pytest.mark.parametrize("size,top", [(0, 1), (1, 1), (511, 2), (512, 300), (513, 50257), (5000, 7), (3000, 70000)])
def test_wavelet_matrix(size, top):
    r = np.random.default_rng(size)
    ids = r.integers(0, top, size)
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.build(ids).to_bytes())
    assert matrix.all().tolist() == ids.tolist()
    places = r.integers(0, size, 50) if size else np.empty(0, int)
    assert matrix.access(places).tolist() == ids[places].tolist()
    for v in {0, 1, top - 1, top + 5, *ids[:5].tolist()}:
        assert matrix.count(v) == (ids == v).sum()
        assert matrix.count(v, size // 3) == (ids[: size // 3] == v).sum()
        assert matrix.occurrences(v).tolist() == np.flatnonzero(ids == v).tolist()
