"""Document fingerprints by locally consistent parsing.

A text is cut into phrases by rules that look only at a few neighbouring symbols, the phrases get
names, and the sequence of names is cut again, level by level. Equal substrings are therefore cut
alike, wherever they stand, but for a few symbols at their ends.

One level: a run of an equal symbol becomes one symbol; deterministic coin tossing (the lowest bit in
which a symbol differs from its left neighbour, with that bit's value, four times over) turns names
into labels under 6 that differ between neighbours; a phrase starts where a label is greater than
both neighbours; a phrase's name is a hash of its symbols in order.

The fingerprint keeps, of all phrase names from level ``FIRST`` up (repeats counted), the least hash in each of 64 bins, 16 bits of it: 256 hexadecimal digits. The likeness of
two fingerprints is the share of equal bins among those that either has, which estimates how many of
their phrases two texts share.

Empty and null texts have the fingerprint of no phrase; two of them are alike (1), one and another
text are not (0). Equal texts have equal fingerprints. A null ``doc_id`` comes first, equal ids are in
the order of their compressed texts; the next of the last is the first, also of a single row. An empty
table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brickrow.llm.common import in_order, steps, unpacked

BINS = 64
#: Phrases of lower levels are too short to tell texts apart.
FIRST = 2
LEVELS = 24
#: Code points parsed at once; a longer text is parsed alone.
BLOCK = 1 << 18

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _low_bit(d: np.ndarray) -> np.ndarray:
    """Place of the lowest set bit of words that are not 0."""
    return np.bitwise_count((d & (~d + np.uint64(1))) - np.uint64(1))


#: Label of (symbol, left neighbour) for symbols under 128.
_a, _b = np.meshgrid(np.arange(128, dtype=np.uint64), np.arange(128, dtype=np.uint64), indexing="ij")
_d = np.where(_a == _b, np.uint64(1), _a ^ _b)
_TOSS = (2 * _low_bit(_d) + ((_a >> _low_bit(_d).astype(np.uint64)) & np.uint64(1))).astype(np.uint8).ravel()


def labels(x: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Labels under 6, different for neighbours of one text. ``head`` marks the first symbol of each text."""
    left = np.empty_like(x)
    left[1:] = x[:-1]
    left[head] = x[head] ^ np.uint64(1)
    k = _low_bit(x ^ left)
    label = (k << np.uint8(1)) | ((x >> k.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
    for _ in range(3):
        pair = label.astype(np.uint16) << np.uint16(7)
        pair[1:] |= label[:-1]
        pair[head] = (label[head].astype(np.uint16) << np.uint16(7)) | (label[head] ^ 1)
        label = _TOSS[pair]
    return label


def level(x: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names, and the text that each belongs to."""
    new = np.empty(len(x), bool)
    new[0] = True
    np.not_equal(text[1:], text[:-1], out=new[1:])
    start = new.copy()
    start[1:] |= x[1:] != x[:-1]
    at = np.flatnonzero(start)
    if len(at) < len(x):
        runs = np.diff(at, append=len(x))
        x, text, new = x[at], text[at], new[at]
        long = runs > 1
        x[long] = mix(x[long] ^ (runs[long].astype(np.uint64) * _STEP))
    label = labels(x, new)
    peak = new.copy()
    peak[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~new[2:]
    starts = np.flatnonzero(peak)
    sizes = np.diff(starts, append=len(x))
    place = np.arange(len(x)) - np.repeat(starts, sizes)
    names = np.add.reduceat(mix(x + (place.astype(np.uint64) + np.uint64(1)) * _STEP), starts)
    return mix(names ^ sizes.astype(np.uint64)), text[starts]


def fingerprints(texts: list[str]) -> np.ndarray:
    """A row of ``BINS`` 16-bit values for each text; 0 is a bin without phrase."""
    best = np.full((len(texts), BINS), np.iinfo(np.uint64).max, np.uint64)
    done = np.zeros(len(texts), bool)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    x = mix(points + _STEP) if len(points) else points

    def keep(names, owner):
        value = mix(names + _STEP)
        # The second, third ... occurrence of a name in a text counts as a name of its own.
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(new)
        nth = np.arange(len(value)) - np.repeat(starts, np.diff(starts, append=len(value)))
        again = nth > 0
        value[again] = mix(value[again] + nth[again].astype(np.uint64) * _STEP)
        slot = owner * BINS + (value >> np.uint64(58)).astype(np.int64)
        np.minimum.at(best.reshape(-1), slot, value)

    for depth in range(1, LEVELS + 1):
        if not len(x):
            break
        x, text = level(x, text)
        count = np.bincount(text, minlength=len(texts))
        if depth >= FIRST:
            # A text that is one phrase is named once more, then left alone.
            keep(x, text)
            done |= count == 1
            stay = ~done[text]
            x, text = x[stay], text[stay]
    best[best == np.iinfo(np.uint64).max] = 0
    some = best > 0
    return np.where(some, np.maximum(best & np.uint64(0xFFFF), np.uint64(1)), np.uint64(0)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, the share of equal bins among those that either has; 1 if neither has any."""
    either = (a > 0) | (b > 0)
    n = either.sum(1)
    return np.where(n == 0, 1.0, (either & (a == b)).sum(1) / np.maximum(n, 1))


def as_hex(rows: np.ndarray) -> list[str]:
    return [r.astype(">u2").tobytes().hex() for r in rows]


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many from the beginning of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n] if n else text


def _blocks(texts: list[str]) -> list[tuple[int, int]]:
    out, a, size = [], 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK:
            out.append((a, i))
            a, size = i, 0
        size += len(t)
    return [*out, (a, len(texts))] if texts else out


def fingerprinted(texts: list[str]) -> np.ndarray:
    parts = [fingerprints(texts[a:b]) for a, b in _blocks(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, BINS), np.uint16)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_edits(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, its edited text's, and their likeness and that to the next document's.

    One exchange, of compressed texts; the next document of a partition's last row is read ahead.
    """

    def run(batches):
        names = [f.strip().split()[0] for f in SCHEMA.split(",")]
        held = None  # the last row of the batch before: its next is not known yet
        for batch in steps(batches, "packed", 1 << 20):
            ids, ahead = batch.column("doc_id").to_pylist(), batch.column("ahead").to_pylist()
            texts = [x.decode() for x in unpacked(batch.column("packed"))]
            if True in ahead:
                end = ahead.index(True) + 1
                ids, texts, ahead = ids[:end], texts[:end], ahead[:end]
            prints = fingerprinted(texts)
            if held is not None:
                if held[3]:
                    continue  # further rows that were read ahead
                ids, texts, ahead = [held[0], *ids], [held[1], *texts], [False, *ahead]
                prints = np.concatenate([held[2][None], prints])
            held = (ids[-1], texts[-1], prints[-1], ahead[-1])
            rows = len(texts) - 1
            if not rows:
                continue
            changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
            after = fingerprinted(changed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[:rows], pa.int64()),
                    pa.array([len(t) for t in texts[:rows]], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                    pa.array(as_hex(prints[:rows])),
                    pa.array(as_hex(after)),
                    pa.array(likeness(prints[:rows], after)),
                    pa.array(likeness(prints[:rows], prints[1:])),
                ],
                names=names,
            )

    return in_order(docs, lookahead=True).rows.mapInArrow(run, SCHEMA)
