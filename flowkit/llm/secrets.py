"""Secrets in texts: fixed patterns, and a character network over every candidate."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowkit.llm.chunks import SLICE, slices
from flowkit.llm.planted import findings

# The base patterns and the least length of what they find.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 18
HEX_LENGTH = 16
#: One of them, in lower case, is in every text that ``ASSIGN`` finds something in.
_KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

_TOKEN = np.isin(np.arange(256), np.frombuffer(b"+/_=-", np.uint8))
for _a, _b in ("09", "AZ", "az"):
    _TOKEN[ord(_a) : ord(_b) + 1] = True
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))
_HEX = _DIGIT | np.isin(np.arange(256), np.arange(97, 103))
#: A candidate is a run of token characters so long, with a digit; or so long without one.
WITH_DIGIT, WITHOUT = 12, 20
#: Bytes before a stretch of a candidate, of it, and behind it that the network sees at once.
BEFORE, INSIDE, BEHIND = 24, 40, 8
WIDTH = BEFORE + INSIDE + BEHIND
#: Kind of the spans that only the network finds.
LEARNED = "learned"


def _runs(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of true of ``least`` and more that do not cross the bounds of texts."""
    if not len(mask):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    before = np.concatenate([[False], mask[:-1]])
    before[starts[starts < len(mask)]] = False
    after = np.concatenate([mask[1:], [False]])
    after[ends[ends > 0] - 1] = False
    first, last = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    keep = last - first >= least
    return first[keep], last[keep]


@dataclass
class Findings:
    """What one text holds, places in code points: base matches by kind, and candidates.

    A candidate comes with its windows and whether a base match holds all of it.
    """

    base: list[tuple[int, int, int]]
    candidates: list[tuple[int, int, bytes, bool]]

    def counts(self) -> list[int]:
        return [sum(k == i for _, k, _ in self.base) for i in range(len(KINDS))]

    def listed(self) -> str:
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in self.base)


def _windows(text: bytes, first: int, last: int) -> bytes:
    """What the network sees of a candidate: a window for every stretch of it, one behind the other.

    The last stretch ends with the candidate; what is missing is padded with zeros.
    """
    starts = [*range(first, max(first, last - INSIDE), INSIDE), max(first, last - INSIDE)]
    out = []
    for a in starts:
        b = min(last, a + INSIDE)
        out.append(text[max(0, a - BEFORE) : a].rjust(BEFORE, b"\0"))
        out.append(text[a:b].ljust(INSIDE, b"\0"))
        out.append(text[b : b + BEHIND].ljust(BEHIND, b"\0"))
    return b"".join(out)


#: Bytes of texts that are searched together.
_TOGETHER = SLICE


def find(texts: list[bytes]) -> list[Findings]:
    """Base matches and candidates of UTF-8 texts."""
    out, first, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= _TOGETHER or i == len(texts) - 1:
            out += _find(texts[first : i + 1])
            first, size = i + 1, 0
    return out


def _find(texts: list[bytes]) -> list[Findings]:
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    hexes = _runs(_HEX[data], starts, ends, HEX_LENGTH)
    runs = _runs(_TOKEN[data], starts, ends, WITH_DIGIT)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data], dtype=np.int32)])
    good = (digits[runs[1]] > digits[runs[0]]) | (runs[1] - runs[0] >= WITHOUT)
    runs = runs[0][good], runs[1][good]
    hex_of = np.searchsorted(ends, hexes[0], side="right")
    run_of = np.searchsorted(ends, runs[0], side="right")
    hex_cut = np.searchsorted(hex_of, np.arange(len(texts) + 1))
    run_cut = np.searchsorted(run_of, np.arange(len(texts) + 1))
    out = []
    for n, raw in enumerate(texts):
        base: list[tuple[int, int, int]] = []
        low = raw.lower()
        plain = raw.decode() if any(k in low for k in _KEYWORDS) or b"AKIA" in raw else None
        if plain is not None:
            base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(plain) if len(m[2]) >= ASSIGN_VALUE]
            base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(plain) if len(m[0]) >= ACCESS_LENGTH]
        own_hex = slice(hex_cut[n], hex_cut[n + 1])
        own_run = slice(run_cut[n], run_cut[n + 1])
        places = np.concatenate([x[s] for x, s in zip((*hexes, *runs), (own_hex, own_hex, own_run, own_run))])
        if len(places):
            own = data[starts[n] : ends[n]]
            points = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
            points = points[places - starts[n]].tolist()
            h, r = own_hex.stop - own_hex.start, own_run.stop - own_run.start
            base += [(a, 2, b) for a, b in zip(points[:h], points[h : 2 * h])]
            base.sort()
            begins = [a for a, _, _ in base]
            reach = np.maximum.accumulate([b for _, _, b in base]).tolist() if base else []
            bounds = (places[2 * h :] - starts[n]).tolist()
            candidates = [
                (a, b, _windows(raw, x, y), (i := bisect_right(begins, a)) > 0 and reach[i - 1] >= b)
                for a, b, x, y in zip(points[2 * h : 2 * h + r], points[2 * h + r :], bounds[:r], bounds[r:])
            ]
        else:
            base.sort()
            candidates = []
        out.append(Findings(base, candidates))
    return out


# Classes of bytes: padding, digits, lower and upper case letters one by one, other ASCII, the rest.
_CLASS = np.full(256, 100, np.int64)
_CLASS[:128] = np.arange(128) - 28
_CLASS[:32] = 1
_CLASS[0] = 0
_CLASSES = 101


class CharNet:
    """A small convolutional network over the bytes around a candidate.

    Bytes are embedded, with a mark for those of the candidate; a convolution
    is pooled over the candidate's window by its maximum and mean, and a
    linear layer gives a logit. ``scale`` and ``shift`` calibrate it to a
    probability, ``threshold`` is the least probability of a finding, and
    ``recall`` and ``precision`` are what it had on held-out findings. A
    candidate of several windows is as probable as the best of them.
    """

    def __init__(self, filters: int = 16, size: int = 8, width: int = 5, seed: int = 7):
        random = np.random.default_rng(seed)
        self.width = width
        self.weights = {
            "embed": random.normal(0, 0.3, (_CLASSES, size)).astype(np.float32),
            "filters": random.normal(0, 0.2, (width * (size + 1), filters)).astype(np.float32),
            "bias": np.zeros(filters, np.float32),
            "out": random.normal(0, 0.2, (2 * filters, 1)).astype(np.float32),
            "base": np.zeros(1, np.float32),
        }
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5
        self.recall, self.precision = 0.0, 0.0

    def _forward(self, windows: np.ndarray) -> tuple[np.ndarray, tuple]:
        w = self.weights
        codes = _CLASS[windows]
        mark = np.zeros((*codes.shape, 1), np.float32)
        mark[:, BEFORE : BEFORE + INSIDE, 0] = windows[:, BEFORE : BEFORE + INSIDE] > 0
        embedded = np.concatenate([w["embed"][codes], mark], axis=2)
        view = np.lib.stride_tricks.sliding_window_view(embedded, self.width, axis=1)
        columns = view.transpose(0, 1, 3, 2).reshape(len(codes), -1, self.width * embedded.shape[2])
        active = np.maximum(columns @ w["filters"] + w["bias"], 0)
        top = active.argmax(1)
        pooled = np.concatenate([active.max(1), active.mean(1)], axis=1)
        return (pooled @ w["out"] + w["base"])[:, 0], (codes, columns, active, top, pooled)

    def logits(self, windows: np.ndarray) -> np.ndarray:
        parts = [self._forward(windows[i : i + 512])[0] for i in range(0, len(windows), 512)]
        return np.concatenate(parts) if parts else np.empty(0, np.float32)

    def probability(self, windows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(windows) + self.shift, -30, 30)))

    def probabilities(self, candidates: list[bytes]) -> np.ndarray:
        """The probability of each candidate, given by its windows."""
        if not candidates:
            return np.empty(0)
        counts = np.array([len(c) // WIDTH for c in candidates])
        return np.maximum.reduceat(self.probability(_rows(candidates)), np.cumsum(counts) - counts)

    def _gradients(self, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        logit, (codes, columns, active, top, pooled) = self._forward(windows)
        error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) / len(labels)).astype(np.float32)[:, None]
        back = error @ w["out"].T
        filters = active.shape[2]
        grad = np.repeat(back[:, None, filters:] / active.shape[1], active.shape[1], axis=1)
        rows, cols = np.indices(top.shape)
        grad[rows, top, cols] += back[:, :filters]
        grad *= active > 0
        flat = grad.reshape(-1, filters)
        into = (grad @ w["filters"].T).reshape(len(codes), active.shape[1], self.width, -1)[..., :-1]
        embed = np.zeros_like(w["embed"])
        for k in range(self.width):
            np.add.at(embed, codes[:, k : k + active.shape[1]], into[:, :, k])
        return {
            "embed": embed,
            "filters": columns.reshape(-1, columns.shape[2]).T @ flat,
            "bias": flat.sum(0),
            "out": pooled.T @ error,
            "base": error.sum(0),
        }

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 6, batch: int = 64, seed: int = 7) -> None:
        """Adam on the cross entropy, in an order fixed by the seed."""
        random = np.random.default_rng(seed)
        means = {k: np.zeros_like(v) for k, v in self.weights.items()}
        squares = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            order = random.permutation(len(windows))
            for i in range(0, len(order), batch):
                step += 1
                own = order[i : i + batch]
                for k, g in self._gradients(windows[own], labels[own]).items():
                    means[k] = 0.9 * means[k] + 0.1 * g
                    squares[k] = 0.999 * squares[k] + 0.001 * g * g
                    mean, square = means[k] / (1 - 0.9**step), squares[k] / (1 - 0.999**step)
                    self.weights[k] -= (0.01 * mean / (np.sqrt(square) + 1e-8)).astype(np.float32)

    def calibrate(self, candidates: list[bytes], labels: np.ndarray, recall: float) -> None:
        """Fit a probability to the logits of held-out findings, and take the highest threshold that keeps the recall."""
        counts = np.array([len(c) // WIDTH for c in candidates])
        at = np.cumsum(counts) - counts
        logits = np.maximum.reduceat(self.logits(_rows(candidates)).astype(np.float64), at) if len(at) else np.empty(0)
        positive = int(labels.sum())
        if not 0 < positive < len(labels):
            self.threshold = 2.0  # nothing to tell apart: find nothing more
            return
        target = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (len(labels) - positive + 2))
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps of the logistic fit
            p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
            weight = p * (1 - p) + 1e-9
            miss = p - target
            hessian = np.array(
                [[(weight * logits**2).sum() + 1e-3, (weight * logits).sum()], [(weight * logits).sum(), weight.sum() + 1e-3]]
            )
            move = np.linalg.solve(hessian, [(miss * logits).sum(), miss.sum()])
            a, b = a - move[0], b - move[1]
            if np.abs(move).max() < 1e-9:
                break
        self.scale, self.shift = float(max(a, 1e-3)), float(b)
        own = self.probabilities(candidates)
        secrets = np.sort(own[labels > 0])
        # So many may be missed; a small number guards the product against rounding.
        self.threshold = float(secrets[int((1 - recall) * positive + 1e-9)])
        found = own >= self.threshold
        self.recall = float(found[labels > 0].mean())
        self.precision = float(labels[found].mean())


def _rows(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WIDTH)


#: Made-up findings that a network learns from if no labelled ones are given.
PLANTED = 4000


def planted_findings(count: int = PLANTED, seed: int = 5) -> list[tuple[bytes, bool]]:
    """Windows and labels of made-up secrets of many kinds and of harmless strings; see ``planted``."""
    return [(_windows(text, a, b), secret) for text, a, b, secret, _ in findings(count, seed)]


def labelled_findings(rows: DataFrame, sample: int = 2000) -> list[tuple[bytes, bool]]:
    """At most ``sample`` distinct findings ``windows``, ``secret`` of each label, those with the least hash."""
    out = []
    for label in (True, False):
        some = rows.where(F.col("secret") == label).select("windows").distinct()
        least = some.orderBy(F.xxhash64("windows"), "windows").limit(sample).collect()
        out += [(bytes(r.windows), label) for r in least]
    return [(w, label) for w, label in out if w and len(w) % WIDTH == 0]


def train_network(known: list[tuple[bytes, bool]], recall: float = 0.98, precision: float = 0.0) -> CharNet:
    """A network trained on labelled findings, windows and label, every fourth of each label held out to calibrate.

    The threshold is the highest that finds ``recall`` of the held-out
    secrets. Where fewer than ``precision`` of what it finds are secrets, the
    network is refused: its threshold is beyond any probability, so that it
    finds nothing. The same goes without findings of both labels.
    """
    net, number = CharNet(), {True: 0, False: 0}
    held = np.zeros(len(known), bool)
    for i, (_, label) in enumerate(known):
        held[i] = number[label] % 4 == 3
        number[label] += 1
    labels = np.array([label for _, label in known], np.float32)
    if held.any():
        rows = [(w, label) for (w, label), out in zip(known, held) if not out]
        counts = [len(w) // WIDTH for w, _ in rows]
        net.train(_rows([w for w, _ in rows]), np.repeat(np.array([label for _, label in rows], np.float32), counts))
    net.calibrate([w for (w, _), out in zip(known, held) if out], labels[held], recall)
    if net.precision < precision:
        net.threshold = 2.0
    return net


def _learned(net: CharNet, candidates: list[list[tuple[int, int, bytes, bool]]]) -> list[list[tuple[int, int]]]:
    """The candidates of each text that the network takes for a secret, but for those that a base match holds."""
    each = [(n, *c) for n, own in enumerate(candidates) for c in own]
    out: list[list[tuple[int, int]]] = [[] for _ in candidates]
    for i in range(0, len(each), 4096):
        part = each[i : i + 4096]
        for (n, a, b, _, known), p in zip(part, net.probabilities([w for *_, w, _ in part])):
            if p >= net.threshold and not known:
                out[n].append((a, b))
    return out


def _spans(base: str, learned: list[tuple[int, int]]) -> str:
    order = {k: i for i, k in enumerate((*KINDS, LEARNED))}
    spans = [(int(a), order[k], k, int(b)) for k, a, b in (x.split(":") for x in base.split(",") if x)]
    spans += [(a, order[LEARNED], LEARNED, b) for a, b in learned]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))


def scan_secrets(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    sample: int = 2000,
    recall: float = 0.98,
    precision: float = 0.9,
) -> DataFrame:
    """Secrets in each row of ``doc_id``, ``text``: ``n_assign``, ``n_access``, ``n_hex``, ``base``, ``spans``.

    ``base`` lists the matches of the base patterns as ``kind:start:end``, in
    code points, by start and kind; ``spans`` adds the candidates (runs of
    token characters, 12 with a digit or 20 without) that a character network
    takes for secrets and that no base match holds whole. Every candidate is
    scored, over all its bytes. The network learns from ``labelled`` findings
    (``windows``, ``secret``; at most ``sample`` of each label), by default
    from made-up ones, never from what the base patterns find; see
    ``train_network`` for ``recall`` and ``precision``. A NULL text counts as
    empty; rows with a NULL id, and repeated ones, come back like any other.
    Texts are read once and never moved.
    """
    net = _network(labelled, sample, recall, precision)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", _TOGETHER):
            found = find(batch.column("body").to_pylist())
            counts = np.array([f.counts() for f in found], np.int64).reshape(-1, len(KINDS))
            base = [f.listed() for f in found]
            spans = [_spans(b, s) for b, s in zip(base, _learned(net, [f.candidates for f in found]))]
            columns = [*(pa.array(c) for c in counts.T), pa.array(base, pa.string()), pa.array(spans, pa.string())]
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"))
    return plain.mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string")


def _network(labelled: DataFrame | None, sample: int, recall: float, precision: float) -> CharNet:
    known = planted_findings() if labelled is None else labelled_findings(labelled, sample)
    return train_network(known, recall, precision)


def mask_text(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    """The text with each stretch that spans cover replaced by the mask."""
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_secrets(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    sample: int = 2000,
    recall: float = 0.98,
    precision: float = 0.9,
    mask: str = "[secret]",
) -> DataFrame:
    """The rows of ``docs``, all columns, with the secrets in ``text`` masked and ``n_chars`` brought up to date.

    ``n_chars`` is only touched where a text changes. See ``scan_secrets``.
    """
    net = _network(labelled, sample, recall, precision)
    at = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _TOGETHER):
            texts = batch.column(at).to_pylist()
            found = find([(t or "").encode() for t in texts])
            learned = _learned(net, [f.candidates for f in found])
            columns = list(batch.columns)
            sizes = columns[size].to_pylist() if size is not None else None
            for i, (f, more) in enumerate(zip(found, learned)):
                spans = [(a, b) for a, _, b in f.base] + more
                if spans:
                    texts[i] = mask_text(texts[i], spans, mask)
                    if sizes is not None:
                        sizes[i] = len(texts[i])
            columns[at] = pa.array(texts, columns[at].type)
            if sizes is not None:
                columns[size] = pa.array(sizes, columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(redact, docs.schema)
