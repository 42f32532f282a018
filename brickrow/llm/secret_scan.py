"""Secrets by patterns and by a linear-chain conditional random field.

The base patterns find assignments, access keys and long hexadecimal runs. The field then tags every
token of a text as outside, begin or inside of a secret, from the token's shape (length, character
classes, changes of class), its neighbours (the word before, what stands between, what follows) and
features of the file (how many tokens have digits, whether it has assignments). Decoding is Viterbi's
algorithm. It adds spans of kind ``crf`` that overlap no base span.

Decoding is exact but only walks where it must: where state "outside" leads by more than two
transitions could ever make up, every best path is outside, so the text is cut there and only the
stretches between such tokens go through the recursion, all of a batch at once.

The field is learned here, from the base spans of a bounded sample of documents (``SAMPLE``, at most
``WINDOWS`` stretches of tokens each), by gradient ascent on the conditional likelihood. Every stretch
is seen a second time without the features that the patterns themselves look at (``HIDDEN``), so that
shape and file have to tell secrets too. Without a base span in the sample there is nothing to learn
and no span is added.

Offsets count code points, ends are exclusive. Null and empty texts have no spans. Repeated rows and
null ids are scanned like any other. An empty table gives no rows. Only ``doc_id`` and ``text`` are
read by the scan; ``redact`` keeps every column of its input, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickrow.llm.common import exact, sample, steps, texts_of

#: Documents that the field is fitted on, and stretches taken from each, at most.
SAMPLE = 4000
WINDOWS = 6
#: Tokens on either side of the middle of a stretch.
REACH = 10
ROUNDS = 90
RATE = 0.2
PENALTY = 2e-6
KINDS = ("assign", "access", "hex", "crf")

_ASSIGN = re.compile(
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: Text that one step scans, in bytes.
STEP = 2 << 20
_WORDS = ("password", "passwd", "secret", "token", "api")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{24,}")  # a run of hexadecimal digits is one match, whatever its length


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """``kind, start, end, start of the secret itself`` by start, then kind."""
    low = text.lower()
    out = []
    if any(w in low for w in _WORDS):
        out += [(0, m.start(), m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(1, *m.span(), m.start()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(2, *m.span(), m.start()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[1], x[0]))


# Tokens and their features, for many texts at once.

_CLASS = np.zeros(256, np.uint8)  # 0 between tokens, else 1 lower, 2 upper, 3 digit, 4 other
_CLASS[[*b"abcdefghijklmnopqrstuvwxyz"]] = 1
_CLASS[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 2
_CLASS[[*b"0123456789"]] = 3
_CLASS[[*b"_+/.-", *range(128, 256)]] = 4
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.int64)
_COUNT = np.array([0, 1, 1 << 16, 1 << 32, 1 << 48], np.uint64)
_GAP = np.zeros(256, np.uint8)
_GAP[[*b"=:"]] = 1
_GAP[[*b"\"'`"]] = 2
_GAP[[10]] = 4
_SIZES = np.array([3, 5, 8, 12, 16, 20, 24, 32, 40])
_HASHES = 256

#: Values of each feature; a token has one of each.
FEATURES = {
    "length_and_classes": (len(_SIZES) + 1) * 16,
    "length_and_changes": (len(_SIZES) + 1) * 6,
    "digits": 8,
    "before": 8,
    "word_before": _HASHES,
    "word_before_and_gap": _HASHES * 2,
    "beginning": _HASHES,
    "after": 8,
    "file": 8,
}
_OFFSET = np.cumsum([0, *FEATURES.values()])
HIDDEN = ("before", "word_before", "word_before_and_gap", "beginning")


class Tokens:
    """``start, end`` (bytes in the joined texts) and ``text`` of every token; ``features`` are one row each."""

    def __init__(self, data: list[bytes]):
        joined = np.frombuffer(b"\n".join(data) + b"\n\n", np.uint8)
        self.base = np.cumsum([0, *(len(d) + 1 for d in data)])
        kind = _CLASS[joined]
        inside = kind > 0
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[::2], edge[1::2]
        self.text = np.searchsorted(self.base, self.start, "right") - 1
        self.features = self._features(joined, kind)

    def _features(self, joined: np.ndarray, kind: np.ndarray) -> list[np.ndarray]:
        s, e = self.start, self.end
        if not len(s):
            return []
        cuts = np.column_stack([s, e]).ravel()
        counts = np.add.reduceat(_COUNT[kind], cuts)[::2]
        lower, upper, digit, other = (((counts >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64) for k in range(4))
        change = np.zeros(len(kind), np.int32)
        change[1:] = kind[1:] != kind[:-1]
        changes = np.add.reduceat(change, cuts)[::2] - change[s]
        size = np.searchsorted(_SIZES, e - s, "right")
        classes = (lower > 0) + 2 * (upper > 0) + 4 * (digit > 0) + 8 * (other > 0)
        gap = np.bitwise_or.reduceat(_GAP[joined], np.column_stack([e, np.append(s[1:], len(joined) - 1)]).ravel())[::2]
        # Beyond the ends of a text there is a line's end, whatever text stands next to it here.
        head_of, last_of = np.ones(len(s), bool), np.ones(len(s), bool)
        head_of[1:] = last_of[:-1] = self.text[1:] != self.text[:-1]
        gap[last_of] = 4
        before = np.concatenate([[4], gap[:-1]]).astype(np.int64)
        first = _LOWER[joined[s]] * 31 + _LOWER[joined[np.minimum(s + 1, e - 1)]] * 131 + _LOWER[joined[np.minimum(s + 2, e - 1)]] * 17
        word = (first + _LOWER[joined[e - 1]] * 7 + (e - s) * 59) * 40503 >> 7 & _HASHES - 1
        head = (first + _LOWER[joined[np.minimum(s + 3, e - 1)]] * 71) * 40503 >> 7 & _HASHES - 1
        previous = np.where(head_of, 0, np.concatenate([[0], word[:-1]]))
        share = np.bincount(self.text, digit > 0) / np.maximum(np.bincount(self.text), 1)
        signs = np.bincount(self.text, gap & 1) > 0
        file = np.searchsorted([0.001, 0.02, 0.2], share, "right") + 4 * signs
        return [
            size * 16 + classes,
            size * 6 + np.searchsorted([1, 2, 4, 8, 16], changes, "right"),
            np.searchsorted([1, 2, 4, 6, 9, 13, 17], digit, "right"),
            before,
            previous,
            previous * 2 + (before & 1),
            head,
            gap.astype(np.int64),
            file[self.text],
        ]

    def chars(self, data: list[bytes], text: int, at: int) -> int:
        """A byte place in the joined texts as code points of its text."""
        return len(data[text][: at - self.base[text]].decode("utf-8", "ignore"))


def label(tokens: Tokens, spans: list[tuple[int, int]]) -> np.ndarray:
    """States of the tokens for secrets that begin and end at these bytes of the joined texts."""
    states = np.zeros(len(tokens.start), np.int8)
    for a, b in spans:
        i, j = np.searchsorted(tokens.end, a, "right"), np.searchsorted(tokens.start, b, "left")
        states[i:j] = 2
        states[i : min(i + 1, j)] = 1
    return states


def _stretches(batches) -> Iterator[pa.RecordBatch]:
    """Stretches of tokens around base spans, tokens with digits, and the middle of each text."""
    for batch in steps(batches, "text"):
        texts = texts_of(batch.column("text"))
        for text in texts:
            data = [text.encode()]
            tokens = Tokens(data)
            n = len(tokens.start)
            if not n:
                continue
            spans = [(len(text[:x[3]].encode()), len(text[: x[2]].encode())) for x in base_spans(text)]
            states = label(tokens, spans)
            hot = np.flatnonzero(states == 1)
            odd = np.flatnonzero((tokens.features[2] > 0) & (states == 0))
            middles = [*hot[: WINDOWS // 2], *odd[:: max(1, len(odd) // (WINDOWS // 2))][: WINDOWS // 2 - 1], n // 2]
            rows = []
            for m in middles:
                a, b = max(0, m - REACH), min(n, m + REACH + 1)
                rows.append((np.stack([f[a:b] for f in tokens.features]).astype("<i4").tobytes(), states[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*rows)], names=["x", "y"])


class Field:
    """Weights of features for the three states, and of transitions between them."""

    def __init__(self, weights: np.ndarray, steps_: np.ndarray, learned: bool):
        self.weights, self.steps, self.learned = weights, steps_, learned

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        """``[tokens, 3]``"""
        total = self.weights[features[0]]
        for k in range(1, len(features)):
            total += self.weights[features[k] + _OFFSET[k]]
        return total

    def decode(self, scores: np.ndarray, text: np.ndarray) -> np.ndarray:
        """The best states of every text's tokens; ``text`` ascends."""
        out = np.zeros(len(scores), np.int8)
        if not len(scores):
            return out
        lead = scores[:, 0] - np.maximum(scores[:, 1], scores[:, 2])
        open_ = np.flatnonzero(lead <= 2 * (self.steps.max() - self.steps.min()) + 1e-6)
        if not len(open_):
            return out
        cut = np.concatenate([[True], (np.diff(open_) > 1) | (np.diff(text[open_]) > 0)])
        first = open_[cut]
        size = np.diff(np.flatnonzero(cut), append=len(open_))
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        # Before the first token of a text there is no transition; elsewhere the neighbour is outside.
        inner = (first > 0) & (text[np.maximum(first - 1, 0)] == text[first])
        best = scores[first] + np.where(inner[:, None], self.steps[0][None], 0)
        back = [np.zeros((len(first), 3), np.int8)]
        for j in range(1, int(size[0])):
            live = int(np.searchsorted(-size, -j, "left"))
            options = best[:live, :, None] + self.steps[None]
            back.append(options.argmax(1).astype(np.int8))
            best[:live] = options.max(1) + scores[first[:live] + j]
        last = first + size - 1
        inner = (last + 1 < len(text)) & (text[np.minimum(last + 1, len(text) - 1)] == text[last])
        best = best + np.where(inner[:, None], self.steps[:, 0][None], 0)
        state = best.argmax(1).astype(np.int8)
        for j in range(int(size[0]) - 1, -1, -1):
            live = int(np.searchsorted(-size, -j, "left")) if j else len(first)
            out[first[:live] + j] = state[:live]
            if j:
                state[:live] = back[j][np.arange(live), state[:live]]
        return out


def fit(docs: DataFrame, sample_docs: int = SAMPLE) -> Field:
    """A field learned from the base spans of at most ``sample_docs`` documents."""
    rows = sample(exact(docs, "doc_id", "text"), sample_docs).mapInArrow(_stretches, "x binary, y binary").collect()
    width = 2 * REACH + 1
    x = np.full((len(rows), width, len(FEATURES)), -1, np.int64)
    y = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(sorted(rows)):
        states = np.frombuffer(r.y, np.int8)
        x[i, : len(states)] = np.frombuffer(r.x, "<i4").reshape(len(FEATURES), -1).T
        y[i, : len(states)] = states
    if not (y == 1).any():
        return Field(np.zeros((_OFFSET[-1], 3), np.float32), np.zeros((3, 3), np.float32), False)
    blind = x.copy()
    blind[:, :, [list(FEATURES).index(f) for f in HIDDEN]] = -1
    weights, steps_ = learn(np.concatenate([x, blind]), np.concatenate([y, y]))
    return Field(weights.astype(np.float32), steps_.astype(np.float32), True)


def learn(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of greatest penalised conditional likelihood, by gradient steps with moments.

    ``x [stretches, places, features]`` (-1 for no value, and beyond a stretch's end), ``y [stretches, places]``.
    """
    there = x[:, :, 0] >= 0
    size, eye = int(_OFFSET[-1]), np.eye(3)
    codes = np.where(x < 0, size, x + _OFFSET[:-1])[there]  # "no value" has a weight of 0 behind the others
    n = there.sum()
    theta = np.zeros(size * 3 + 9)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    # What the data show: a token's features with its state, and pairs of states.
    pairs = there[:, 1:]
    seen_steps = np.zeros((3, 3))
    np.add.at(seen_steps, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
    places = there.shape[1]
    for t in range(1, ROUNDS + 1):
        w, a = theta[: size * 3].reshape(size, 3), theta[size * 3 :].reshape(3, 3)
        emit = np.zeros((*there.shape, 3))
        emit[there] = np.vstack([w, np.zeros(3)])[codes].sum(1)
        step = np.exp(a)
        # Forward and backward sums, scaled at each place; beyond the end nothing changes.
        local = np.exp(emit - emit.max(2, keepdims=True))
        alpha, beta = np.empty_like(local), np.ones_like(local)
        alpha[:, 0] = local[:, 0] / local[:, 0].sum(1, keepdims=True)
        for j in range(1, places):
            z = (alpha[:, j - 1] @ step) * local[:, j]
            alpha[:, j] = np.where(there[:, j, None], z / z.sum(1, keepdims=True), alpha[:, j - 1])
        for j in range(places - 2, -1, -1):
            z = (beta[:, j + 1] * local[:, j + 1]) @ step.T
            beta[:, j] = np.where(there[:, j + 1, None], z / z.sum(1, keepdims=True), 1.0)
        state = alpha * beta
        state /= state.sum(2, keepdims=True)
        both = alpha[:, :-1, :, None] * step * (local[:, 1:] * beta[:, 1:])[:, :, None, :]
        both /= both.sum((2, 3), keepdims=True)
        off = eye[y[there]] - state[there]
        gradient = np.empty_like(theta)
        g = gradient[: size * 3].reshape(size, 3)
        for k in range(3):
            g[:, k] = np.bincount(codes.ravel(), np.repeat(off[:, k], codes.shape[1]), size + 1)[:size]
        gradient[size * 3 :] = (seen_steps - both[pairs].sum(0)).ravel()
        gradient = gradient / n - PENALTY * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return theta[: size * 3].reshape(size, 3), theta[size * 3 :].reshape(3, 3)


def found(texts: list[str], field: Field) -> list[list[tuple[int, int, int, int]]]:
    """For each text its spans ``kind, start, end, start of the secret itself``: base ones and those of the field."""
    spans = [base_spans(t) for t in texts]
    if not field.learned:
        return spans
    data = [t.encode() for t in texts]
    tokens = Tokens(data)
    if not len(tokens.start):
        return spans
    states = field.decode(field.scores(tokens.features), tokens.text)
    marked = np.flatnonzero(states)
    if not len(marked):
        return spans
    # A secret is a run of marked tokens of one text; a begin starts a new one.
    new = np.concatenate([[True], (np.diff(marked) > 1) | (np.diff(tokens.text[marked]) > 0)]) | (states[marked] == 1)
    begins = marked[new]
    ends = np.append(marked[np.flatnonzero(new)[1:] - 1], marked[-1])
    for i, j in zip(begins, ends):
        k = int(tokens.text[i])
        a, b = tokens.chars(data, k, int(tokens.start[i])), tokens.chars(data, k, int(tokens.end[j]))
        spans[k] += [(3, c, d, c) for c, d in beyond(a, b, [x[1:3] for x in spans[k] if x[0] < 3]) if texts[k][c:d].strip()]
    return [sorted(x, key=lambda x: (x[1], x[0])) for x in spans]


def beyond(a: int, b: int, base: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What a span of the field adds: the whole if it meets no base span, else what follows those inside it."""
    met = sorted(x for x in base if x[0] < b and a < x[1])
    if not met:
        return [(a, b)]
    ends = [max(y for _, y in met[: i + 1]) for i in range(len(met))]
    return [(c, d) for c, d in zip(ends, [x for x, _ in met[1:]] + [b]) if c < d]


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id`` and ``spans``, an array of ``kind, start, end`` in order, for every document."""

    def run(batches):
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in steps(batches, "text", STEP):
            spans = [
                [{"kind": KINDS[k], "start": a, "end": b} for k, a, b, _ in row]
                for row in found(texts_of(batch.column("text")), field)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, pa.list_(span))], names=["doc_id", "spans"]
            )

    rows = exact(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact(docs: DataFrame, field: Field, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; of an assignment, only its value."""
    place = docs.columns.index("text")
    # Positional names inside, so that columns whose names differ only in case do no harm.
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def run(batches):
        at = place
        for batch in steps(batches, f"c{place}", STEP):
            out = []
            values = batch.column(at).to_pylist()
            for text, spans in zip(values, found([v or "" for v in values], field)):
                done, parts = 0, []
                for _, _, end, start in spans:
                    if end > done:
                        # Of overlapping spans the later one only adds what it has beyond the first.
                        if start >= done:
                            parts += [text[done:start], mark]
                        done = end
                out.append(text if not parts else "".join(parts) + text[done:])
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return inner.mapInArrow(run, inner.schema).toDF(*docs.columns)
