"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. A passage is described by the shape of its text
(shares of letters, capitals, symbols, digits; word lengths; repetition within the passage and of what
the document said before) and encoded by a small layer. Gated attention, learned from document labels
alone, weighs the passages; the document's score is a logistic function of the weighted sum of their
codes. The weights say which passages decided.

The model is fitted on the driver on at most ``PER_CLASS`` documents of each label (of each at most
``FIT_PASSAGES`` passages, evenly spread); scoring sees every passage of every whole text.

Null and empty texts are one passage without words. Repeated rows get equal scores. Without labels
every score is 0.5; with one label only, near that label. An empty table gives no rows. Only
``doc_id`` and ``text`` are inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickrow.llm.common import exact, fold, labelled, steps, texts_of

PASSAGE = 64
#: Text that one step describes, in bytes: descriptions take some tens of bytes for each of them.
STEP = 1 << 20
PER_CLASS = 1500
FIT_PASSAGES = 32
HIDDEN, GATE = 16, 8
ROUNDS, RATE, PENALTY = 150, 0.04, 1e-4
THRESHOLD = 0.3

_GROUPS = [
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b"#*$%&@^~=+_",
    b"|",
    b"<>{}[]()/\\",
    b"!?",
    b".,;:",
    b"'\"-`",
    b"\n",
    bytes(range(128, 256)),
]
_GROUP = np.full(256, len(_GROUPS), np.int64)
for _k, _chars in enumerate(_GROUPS):
    _GROUP[[*_chars]] = _k
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
WIDTH = len(_GROUPS) + 1 + 8


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Description of every passage, and the number of the text that it belongs to; at least one for each text."""
    data = [t.encode() for t in texts]
    joined = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    base = np.cumsum([0, *(len(d) + 1 for d in data)])
    word = ~_SPACE[joined]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[::2], edge[1::2]
    owner = np.searchsorted(base, start, "right") - 1
    words = np.bincount(owner, minlength=len(texts))
    nth = np.arange(len(start)) - np.repeat(np.cumsum(words) - words, words)
    # Passages: every PASSAGE words of a text, and one for a text without words.
    count = np.maximum(-(-words // PASSAGE), 1)
    first = np.cumsum(count) - count
    text = np.repeat(np.arange(len(texts)), count)
    x = np.zeros((int(count.sum()), WIDTH), np.float32)
    if not len(start):
        return x, text
    at = first[owner] + nth // PASSAGE  # passage of each word
    n = np.bincount(at, minlength=len(x)).astype(np.float32)
    n1 = np.maximum(n, 1)
    # A passage has the bytes from its first word up to the next passage's, or to the end of its text.
    opens = np.flatnonzero(nth % PASSAGE == 0)
    begin = start[opens]
    span = np.minimum(np.append(begin[1:], base[-1]), base[owner[opens] + 1] - 1) - begin
    groups = len(_GROUPS) + 1
    byte = np.arange(int(span.sum())) + np.repeat(begin - (np.cumsum(span) - span), span)
    of_byte = np.repeat(at[opens], span)
    chars = np.bincount(of_byte * groups + _GROUP[joined[byte]], minlength=len(x) * groups).reshape(-1, groups)
    x[:, :groups] = np.sqrt(chars / np.maximum(chars.sum(1, keepdims=True), 1))
    size = (end - start).astype(np.float32)
    mean = np.bincount(at, size, len(x)) / n1
    spread = np.sqrt(np.maximum(np.bincount(at, size * size, len(x)) / n1 - mean**2, 0))
    # A word's hash: its length, a weighted sum of its bytes, and its first and last byte.
    place = (np.arange(len(joined)) - np.repeat(np.append(0, start), np.diff(np.append(np.append(0, start), len(joined))))).astype(np.uint64)
    code = np.add.reduceat(_LOWER[joined] * word * (place * np.uint64(0x1F1F1F) + np.uint64(7)) * _ODD, start)
    code = (code ^ (code >> np.uint64(29))) * _ODD + owner.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    same = np.zeros(len(start), bool)
    same[1:] = (code[1:] == code[:-1]) & (nth[1:] > 0)
    # Three-word windows that the text had before.
    window = code.copy()
    window[2:] = code[2:] + code[1:-1] * np.uint64(3) + code[:-2] * np.uint64(5)
    order = np.argsort(window, kind="stable")
    seen = np.zeros(len(start), bool)
    seen[order[1:]] = window[order[1:]] == window[order[:-1]]
    seen &= nth >= 2
    caps = np.zeros(len(start), bool)
    upper = np.add.reduceat((_GROUP[joined] == 1).astype(np.int32), start)
    lower = np.add.reduceat((_GROUP[joined] == 0).astype(np.int32), start)
    caps = (upper > lower) & (size > 1)
    symbols = np.add.reduceat((_GROUP[joined] == 3).astype(np.int32), start) > 0
    x[:, groups:] = np.column_stack(
        [
            np.log1p(mean),
            np.log1p(spread),
            np.bincount(at, same, len(x)) / n1,
            np.bincount(at, seen, len(x)) / n1,
            np.bincount(at, caps, len(x)) / n1,
            np.bincount(at, symbols, len(x)) / n1,
            np.log1p(n) / 4,
            n > 0,
        ]
    )
    return x, text


@dataclass
class Model:
    """``None`` weights: the constant ``rate``."""

    rate: float
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: list[np.ndarray] | None = None

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of texts, and the passage of each with the greatest weight."""
        if self.weights is None:
            return np.full(len(texts), self.rate), np.zeros(len(texts), np.int64)
        x, text = passages(texts)
        forward = _forward(self.weights, (x - self.center) / self.scale, np.flatnonzero(np.diff(text, prepend=-1)), text)
        attention = forward["attention"]
        order = np.lexsort((-attention, text))
        first = np.flatnonzero(np.diff(text[order], prepend=-1))
        begin = np.flatnonzero(np.diff(text, prepend=-1))
        return forward["score"], order[first] - begin


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _forward(weights, x, begin, text):
    w, b, v, u, a, c, d = weights
    h = np.tanh(x @ w + b)
    t, s = np.tanh(h @ v), _sigmoid(h @ u)
    e = (t * s) @ a
    e = np.exp(e - np.maximum.reduceat(e, begin)[text])
    attention = e / np.add.reduceat(e, begin)[text]
    z = np.add.reduceat(attention[:, None] * h, begin)
    return {"h": h, "t": t, "s": s, "attention": attention, "z": z, "score": _sigmoid(z @ c + d[0])}


def learn(x: np.ndarray, text: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """Weights of encoder, gates, attention and output by full-batch gradient steps with moments."""
    r = np.random.default_rng(seed)
    begin = np.flatnonzero(np.diff(text, prepend=-1))
    weights = [
        r.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        r.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        r.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        r.normal(0, GATE**-0.5, GATE),
        r.normal(0, HIDDEN**-0.5, HIDDEN),
        np.zeros(1),
    ]
    m, q = [np.zeros_like(p) for p in weights], [np.zeros_like(p) for p in weights]
    weight = weight / weight.sum()
    for step in range(1, ROUNDS + 1):
        w, b, v, u, a, c, d = weights
        f = _forward(weights, x, begin, text)
        h, t, s, attention, z = f["h"], f["t"], f["s"], f["attention"], f["z"]
        g = (f["score"] - y) * weight
        gz = g[:, None] * c
        ga = (gz[text] * h).sum(1)  # of the attention weight
        ge = attention * (ga - np.add.reduceat(attention * ga, begin)[text])
        gt, gs = ge[:, None] * a * s * (1 - t * t), ge[:, None] * a * t * s * (1 - s)
        gh = (attention[:, None] * gz[text] + gt @ v.T + gs @ u.T) * (1 - h * h)
        grads = [x.T @ gh, gh.sum(0), h.T @ gt, h.T @ gs, (t * s).T @ ge, z.T @ g, np.array([g.sum()])]
        for k, grad in enumerate(grads):
            grad = grad + PENALTY * weights[k]
            m[k] = 0.9 * m[k] + 0.1 * grad
            q[k] = 0.99 * q[k] + 0.01 * grad**2
            weights[k] = weights[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(q[k] / (1 - 0.99**step)) + 1e-8)
    return weights


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", per_class: int = PER_CLASS) -> Model:
    rows, class_weight = labelled(docs, labels, column, per_class)

    def describe(batches):
        for batch in steps(batches, "text", STEP):
            x, text = passages(texts_of(batch.column("text")))
            out = []
            for i in range(batch.num_rows):
                own = x[text == i]
                keep = np.unique(np.linspace(0, len(own) - 1, min(len(own), FIT_PASSAGES)).astype(int))
                out.append(own[keep].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(out, pa.binary())], names=["doc_id", "label", "x"]
            )

    typed = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("label").cast("int").alias("label"))
    bags = sorted(typed.mapInArrow(describe, "doc_id long, label int, x binary").limit(4 * per_class).collect())
    y = np.array([r.label for r in bags], float)
    if not len(y):
        return Model(0.5)
    if len(set(y)) < 2:
        return Model(float((y.sum() + 0.5) / (len(y) + 1)))
    parts = [np.frombuffer(r.x, "<f4").reshape(-1, WIDTH) for r in bags]
    x = np.concatenate(parts).astype(float)
    text = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    center, scale = x.mean(0), x.std(0) + 1e-3
    weights = learn((x - center) / scale, text, y, np.array([class_weight[int(k)] for k in y]))
    return Model(0.5, center, scale, weights)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted``, and ``passage``, the one that weighs most."""

    def run(batches):
        for batch in steps(batches, "text", STEP):
            score, passage = model.score(texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score.astype(float)), pa.array(passage.astype(np.int64))],
                names=["doc_id", "score", "passage"],
            )

    rows = exact(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, passage long"
    )
    return rows.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "passage",
    )
