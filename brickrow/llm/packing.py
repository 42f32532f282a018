"""Packing of documents into sequences of bounded length, by a configuration linear program.

A configuration says how many pieces of each length share a sequence. The program asks for the
fewest sequences whose configurations cover the length histogram. It is solved by multiplicative
weights: every length has a price; a knapsack over prices (dynamic programming over the capacity)
finds the configuration worth most; it takes the largest fractional share that the demand allows, and
the prices of what it used fall. Shares are rounded down, and the few pieces left over go, longest
first, into the open sequence they fit best. All of this sees only counts for each length, at most
``capacity`` numbers, whatever the size of the corpus.

Pieces then take their places in parallel: a piece's rank among those of its length, counted in two
steps (within a task, then over one row for each task and length), picks its slot of the plan.

Null texts are empty; a document without ids (no end id) has one piece of length 0 at the head of a
sequence of its own plan entry. Null ``doc_id`` and repeated rows are packed like any other row. An
empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brickrow.llm.common import bytes_of, exact, steps, stored
from brickrow.llm.encoding import KEPT_WORDS, STEP, encoder

CAPACITY = 2048
#: Prices are renewed so often at most.
ROUNDS = 400
#: By how much the price of the length that a configuration uses up falls, as an exponent.
FALL = 0.3
#: Power of its length by which a piece's first price exceeds its share of a sequence.
LEAN = 0.1

PIECES = "doc_id long, piece long, start long, length long, ids_crc32 long, task long, nth long"


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = 0, kept_words: int = KEPT_WORDS
) -> DataFrame:
    """The pieces of every document, with ``task`` and ``nth``: their number among its pieces of that length.

    A longer document is cut into pieces of ``capacity`` ids; the first may be shorter.
    """

    def cut(batches):
        words = encoder(tokenizer, kept_words)
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), Counter()
        names = [x.split()[0] for x in PIECES.split(", ")]
        for batch in steps(batches, "text", STEP):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.encode(bytes_of(batch.column("text")))):
                data = memoryview(ids + end)
                n = len(data) // 4
                a, b = 0, n if n <= capacity else (n - 1) % capacity + 1
                for k in range(max(1, -(-n // capacity))):
                    rows.append((doc_id, k, a, b - a, zlib.crc32(data[4 * a : 4 * b]), task, seen[b - a]))
                    seen[b - a] += 1
                    a, b = b, b + capacity
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=names)

    return exact(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def knapsack(values: np.ndarray, capacity: int) -> dict[int, int]:
    """Counts for each length (the index) of greatest total value that fit; lengths without value are left out."""
    items = np.flatnonzero(values[: capacity + 1] > 0)
    items = items[items > 0]
    if not len(items):
        return {}
    worth = values[items]
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    ends = np.searchsorted(items, np.arange(capacity + 1), "right")
    for c in range(int(items[0]), capacity + 1):
        k = ends[c]
        total = best[c - items[:k]] + worth[:k]
        j = k - 1 - int(total[::-1].argmax())  # of equals the longest piece
        best[c], took[c] = total[j], items[j]
        if best[c - 1] > best[c]:
            best[c], took[c] = best[c - 1], 0
    out, c = Counter(), capacity
    while c > 0:
        if took[c]:
            out[int(took[c])] += 1
            c -= int(took[c])
        else:
            c -= 1
    return dict(out)


def solve(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """Configurations and how many sequences have each; together they hold exactly ``counts`` (lengths from 1)."""
    need = np.zeros(capacity + 1)
    for length, n in counts.items():
        need[length] = n
    lengths, rest = np.arange(capacity + 1, dtype=float), need.copy()
    # Long pieces are the harder ones to place, so they start dearer than in proportion to their length.
    price = (np.maximum(lengths, 1) / capacity) ** LEAN
    shares: list[tuple[dict[int, int], float]] = []
    for _ in range(rounds):
        # A configuration may not ask for more of a length than there is.
        found = {k: min(a, int(need[k])) for k, a in knapsack(np.where(rest > 0, price * lengths, 0), capacity).items()}
        if not found:
            break
        keys = np.array(list(found))
        used = np.array(list(found.values()), float)
        share = float((rest[keys] / used).min())
        shares.append((found, share))
        rest[keys] = np.maximum(rest[keys] - used * share, 0)
        rest[rest < 1e-9] = 0
        fell = used * share / need[keys]
        price[keys] *= np.exp(-FALL * fell / fell.max())
    # Late configurations are made of what is left and may waste room: of some numbers of rounds, keep the best.
    ends = sorted({max(1, len(shares) * k // 8) for k in range(1, 9)})
    return min((rounded(shares[:end], counts, capacity) for end in ends), key=lambda x: sum(n for _, n in x), default=[])


def rounded(shares: list, counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Whole sequences of each share, and the pieces left over by best fit."""
    plan, left = [], Counter(counts)
    for config, share in shares:
        times = int(share + 1e-9)
        if times:
            plan.append((config, times))
            for length, a in config.items():
                left[length] -= a * times
    return plan + best_fit({k: n for k, n in left.items() if n > 0}, capacity)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Longest first, each into the open sequence with the least room that is enough; equal sequences are one entry."""
    open_: dict[int, Counter] = defaultdict(Counter)  # room -> contents -> sequences
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            room = min((r for r, x in open_.items() if r >= length and x), default=None)
            if room is None:
                each = max(1, capacity // length)
                full, part = divmod(n, each)
                for size, times in ((each, full), (part, 1)):
                    if size and times:
                        open_[capacity - size * length][((length, size),)] += times
                break
            contents, times = next(iter(open_[room].items()))
            each = min(room // length, n)
            times = min(times, n // each)
            open_[room][contents] -= times
            if not open_[room][contents]:
                del open_[room][contents]
            open_[room - each * length][(*contents, (length, each))] += times
            n -= each * times
    return [(dict(c), n) for room in open_.values() for c, n in room.items()]


@dataclass
class Slots:
    """Of one length: from which rank on, pieces in a sequence, first sequence and offset."""

    rank: list[int] = field(default_factory=lambda: [0])
    each: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)


def slots(plan: list[tuple[dict[int, int], int]]) -> dict[int, Slots]:
    out: dict[int, Slots] = defaultdict(Slots)
    first = 0
    for config, times in plan:
        offset = 0
        for length in sorted(config, reverse=True):
            s = out[length]
            s.each.append(config[length])
            s.sequence.append(first)
            s.offset.append(offset)
            s.rank.append(s.rank[-1] + config[length] * times)
            offset += length * config[length]
        first += times
    return dict(out)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = 0, kept_words: int = KEPT_WORDS
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece.

    ``kept_words``: words whose ids a worker keeps, some 200 bytes each, also while it does other work.
    """
    rows = stored(pieces(docs, tokenizer, capacity, end_id, kept_words), "pieces")
    counts = rows.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        F.col("length").alias("of_length"),
        F.col("task").alias("of_task"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
    )
    # At most ``capacity`` rows come to the driver.
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    empty = histogram.pop(0, 0)
    plan = solve(histogram, capacity)
    if empty:
        plan.append(({0: empty}, 1))
    of = {length: [np.array(x) for x in (s.rank, s.each, s.sequence, s.offset)] for length, s in slots(plan).items()}

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("nth").to_numpy() + batch.column("first").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                ranks, each, sequences, offsets = of[int(x)]
                k = np.searchsorted(ranks, rank[at], "right") - 1
                nth = rank[at] - ranks[k]
                sequence[at] = sequences[k] + nth // each[k]
                offset[at] = offsets[k] + nth % each[k] * x
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    ranked = rows.join(first, (F.col("length") == F.col("of_length")) & (F.col("task") == F.col("of_task")))
    placed = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "nth", "first")
    return placed.mapInArrow(
        place, "doc_id long, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long"
    ).withColumn("piece", F.col("piece").cast("int"))
