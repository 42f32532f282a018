"""Phrases of two to four words by collocation, counted over a prefix-free parsing of the corpus.

Texts (ASCII letters lower-cased, null: empty) are split at ``.,;:!?`` and ``\\x0A-\\x0D`` into pieces
and those at spaces and tabs into words. Everything is counted for each ``lang`` (null: ``und``).

1. Parsing. A word whose hash is a multiple of ``PERIOD`` triggers a new chunk, as does the start of a
   text; after ``LONGEST`` words without a trigger one starts too. A chunk owns its words and carries
   up to three more that follow in the same piece, so every phrase lies whole in the one chunk that owns
   its first word. Chunks depend on content, so texts that share a passage share its chunks.
2. Dictionary. Equal chunks become one, with their number: the only exchange of text.
3. Counts. Phrases are counted inside the distinct chunks, each weighted by its chunk's number. A phrase
   as frequent as asked for has only words and pairs that are as frequent, so counts of hashes of words,
   then of pairs, set bits of filters, and only phrases that pass these are counted as texts, exactly.

A filter has 16 to 32 bits for each frequent hash and at most ``MOST_BITS``, so a broadcast is at most
32 MB; a full filter, or a collision in it, lets more phrases be counted and changes no result. Inside one
group of a task, phrases are summed under 64-bit hashes before they are spelled out.

A frequent phrase or a language that most rows have is summed in tasks before its rows meet; the first
phrases of a language are found in tasks before they are ranked.

Odd input: null and empty texts, and such of separators alone, have no words. Rows that repeat count
each; ``doc_id`` is not used, and further columns make no difference, also those whose names differ only
in case. Equal scores rank by count, then by the phrase. An empty table gives no rows. Words and texts
of any length are whole; a chunk is at most ``LONGEST`` words and three, however long these are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brickrow.llm.common import exact, steps, stored

LONGEST_PHRASE = 4
LEAST_COUNT = 30
TOP = 2000
SCALE = 2_000_000
#: A phrase goes when a longer one around it has this many hundredths of its occurrences.
COVERED = 80
PERIOD = 24
LONGEST = 96
BITS_PER_KEY = 16
MOST_BITS = 1 << 28
#: Words that are counted together in a task.
GROUP_WORDS = 500_000

_UNKNOWN = "und"
_BUCKET_BITS = 1 << 15
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_WORD, _BLANK, _CUT = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _CUT
# Hash constants: an odd base and its inverse modulo 2**64, and odd multipliers.
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _STEP
    return h ^ (h >> np.uint64(32))


class Powers:
    """Powers of the base and of its inverse, as many as asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = 1 << n.bit_length()
            self.up = _powers(_BASE, size)
            self.down = _powers(_BASE_INVERSE, size)
        return self.up, self.down


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


@dataclass
class Words:
    """Words of some strings in order: where they are, and hashes of what they are."""

    start: np.ndarray  # of the word in the bytes
    end: np.ndarray
    piece: np.ndarray  # number of its piece, different for each string
    owner: np.ndarray  # number of its string
    hash: np.ndarray
    sums: np.ndarray  # from which hashes of further spans follow

    def hash_of(self, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
        """Hashes of other spans of the bytes, as those of words."""
        return _mixed((self.sums[end] - self.sums[start]) * powers.down[start])


def words_of(data: bytes, offsets: np.ndarray, powers: Powers) -> Words:
    """The words of the strings ``data[offsets[i]:offsets[i + 1]]``."""
    codes = np.frombuffer(data, np.uint8)
    kind = _KIND[codes]
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = kind == _WORD
    edge = np.zeros(len(codes) + 1, bool)
    edge[offsets] = True  # a string ends its last word
    at = np.flatnonzero(((inside[1:] != inside[:-1]) | edge) & ((inside[1:] == 1) | (inside[:-1] == 1)))
    start = at[inside[at + 1] == 1]
    end = at[inside[at] == 1]
    owner = np.searchsorted(offsets, start, "right") - 1
    cuts = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(kind == _CUT, out=cuts[1:])
    piece = cuts[start] + owner
    up, down = powers.upto(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=sums[1:])
    return Words(start, end, piece, owner, _mixed((sums[end] - sums[start]) * down[start]), sums)


def _data_of(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts as one lower-cased run of bytes, and where each begins; null is empty."""
    whole = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = whole.buffers()[2]
    low, high = int(offsets[0]), int(offsets[-1])
    return (data[low:high].to_pybytes() if data is not None else b"").translate(LOWER), offsets - low


def chunks_of(texts: pa.Array, powers: Powers, period: int = PERIOD, longest: int = LONGEST) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Chunks of the texts in order: their bytes, how many words each owns, and the text of each."""
    data, offsets = _data_of(texts)
    words = words_of(data, offsets, powers)
    n = len(words.start)
    if not n:
        return [], np.zeros(0, np.int32), np.zeros(0, np.int64)
    number = np.arange(n)
    first = np.ones(n, bool)
    first[1:] = words.owner[1:] != words.owner[:-1]
    trigger = first | (words.hash % np.uint64(period) == 0)
    since = number - np.maximum.accumulate(np.where(trigger, number, 0))
    begin = np.flatnonzero(trigger | (since % longest == 0))
    stop = np.append(begin[1:], n)
    last = stop - 1
    for _ in range(LONGEST_PHRASE - 1):
        after = np.minimum(last + 1, n - 1)
        last = np.where(words.piece[after] == words.piece[stop - 1], after, last)
    view = memoryview(data)
    found = [bytes(view[a:b]) for a, b in zip(words.start[begin].tolist(), words.end[last].tolist())]
    return found, (stop - begin).astype(np.int32), words.owner[begin]


def dictionary(docs: DataFrame, period: int = PERIOD, longest: int = LONGEST) -> DataFrame:
    """``lang, own, chunk, n``: distinct chunks, the words each owns, and how often it occurs."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in steps(batches, "text"):
            found, own, owner = chunks_of(batch.column("text"), powers, period, longest)
            langs = batch.column("lang").take(pa.array(owner))
            columns = [langs, pa.array(own), pa.array(found, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "own", "chunk"])

    rows = exact(docs, "lang", "text").select(F.coalesce("lang", F.lit(_UNKNOWN)).alias("lang"), "text")
    parsed = rows.mapInArrow(parse, "lang string, own int, chunk string")
    return stored(parsed.groupBy("lang", "own", "chunk").agg(F.count("*").alias("n")), "chunks")


class Filter:
    """A Bloom filter with two bits for each key."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        buckets = len(self.bits) // (_BUCKET_BITS // 8)
        base = (keys & np.uint64(buckets - 1)).astype(np.int64) * (_BUCKET_BITS // 8)
        found = np.ones(len(keys), bool)
        for shift in (32, 47):
            place = ((keys >> np.uint64(shift)) & np.uint64(_BUCKET_BITS - 1)).astype(np.int64)
            found &= (self.bits[base + (place >> 3)] >> (place & 7).astype(np.uint8)) & 1 == 1
        return found


def filter_of(keys: DataFrame, most_bits: int = MOST_BITS) -> Filter:
    """Filter of the longs in the column ``key``; its bitmap is what comes to the driver, at most ``most_bits``."""
    wanted = max(1, min(keys.count() * BITS_PER_KEY, most_bits) // _BUCKET_BITS)
    buckets = 1 << (wanted - 1).bit_length()
    place = lambda shift: F.shiftrightunsigned("key", shift).bitwiseAND(F.lit(_BUCKET_BITS - 1))
    set_bits = keys.select(F.col("key").bitwiseAND(F.lit(buckets - 1)).alias("bucket"), F.explode(F.array(place(32), place(47))).alias("place"))
    bits = np.zeros((buckets, _BUCKET_BITS // 8), np.uint8)
    for row in set_bits.groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits")).toLocalIterator():
        bits[row.bucket] = np.frombuffer(row.bits, np.uint8)
    return Filter(bits.reshape(-1))


@dataclass
class Grams:
    """Chunks of one group as words, and keys of the phrases that begin at each word."""

    data: bytes
    words: Words
    weight: np.ndarray
    lang: np.ndarray
    owned: np.ndarray
    keys: list[np.ndarray]  # by length less one

    def at(self, n: int) -> np.ndarray:
        """Where phrases of ``n`` words begin, each in the chunk that owns it."""
        begin = np.flatnonzero(self.owned)
        begin = begin[begin + n <= len(self.owned)]
        return begin[self.words.piece[begin] == self.words.piece[begin + n - 1]]


def grams_of(batch: pa.Table, powers: Powers, lengths: int) -> Grams:
    data, offsets = _data_of(batch.column("chunk").combine_chunks())
    words = words_of(data, offsets, powers)
    own = batch.column("own").to_numpy()
    n = len(words.start)
    first = np.searchsorted(words.owner, np.arange(len(own)))
    owned = np.arange(n) - first[words.owner] < own[words.owner]
    names, langs = _coded(batch.column("lang").combine_chunks())
    salt = np.array([hash_of(x) for x in names], np.uint64) if names else np.zeros(1, np.uint64)
    keys = [_mixed(words.hash + salt[langs[words.owner]])]
    for k in range(1, lengths):
        longer = np.zeros(n, np.uint64)
        longer[: n - k] = _mixed(keys[-1][: n - k] * _STEP + words.hash[k:])
        keys.append(longer)
    return Grams(data, words, batch.column("n").to_numpy()[words.owner], langs[words.owner], owned, keys)


def _coded(column: pa.Array) -> tuple[list[str], np.ndarray]:
    coded = column.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)


def hash_of(name: str) -> int:
    """A hash of a language's name, the same in every worker."""
    value = 0
    for octet in name.encode():
        value = (value * _BASE + octet + 1) & (2**64 - 1)
    return value


def _groups(batches: Iterator[pa.RecordBatch], limit: int = GROUP_WORDS) -> Iterator[pa.Table]:
    """Batches in groups of about so many words; a step in between bounds what long words take."""
    held, size = [], 0
    for batch in steps(batches, "chunk"):
        held.append(batch)
        size += sum(batch.column("own").to_pylist()) + batch.column("chunk").nbytes // 16
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sum of the weights of each, and a place where each occurs."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(keys) else np.zeros(0, np.int64)
    return ordered[new], np.add.reduceat(weights[order], new) if len(new) else weights[:0], order[new]


def frequent_hashes(chunks: DataFrame, n: int, least: int, known: Filter | None = None) -> DataFrame:
    """``key``: hashes of phrases of ``n`` words that occur ``least`` times or more, and some that collide.

    Only phrases whose words are all ``known`` are looked at.
    """
    given = chunks.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, known = Powers(), given.value
        for group in _groups(batches):
            grams = grams_of(group, powers, n)
            begin = grams.at(n)
            if known is not None:
                good = known.has(grams.keys[0])
                for k in range(n):
                    begin = begin[good[begin + k]]
            keys, sums, _ = _summed(grams.keys[n - 1][begin], grams.weight[begin])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(sums)], names=["key", "f"])

    counted = chunks.select("lang", "own", "chunk", "n").mapInArrow(count, "key long, f long")
    return counted.groupBy("key").agg(F.sum("f").alias("f")).where(F.col("f") >= least).select("key")


def phrases(chunks: DataFrame, words: Filter, pairs: Filter, least: int) -> DataFrame:
    """``lang, size, phrase, f``: all phrases of 1 to 4 words that occur ``least`` times or more, exactly."""
    given = chunks.sparkSession.sparkContext.broadcast((words, pairs))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, (words, pairs) = Powers(), given.value
        for group in _groups(batches):
            grams = grams_of(group, powers, LONGEST_PHRASE)
            langs = pa.array(_coded(group.column("lang").combine_chunks())[0], pa.string())
            word_ok = words.has(grams.keys[0])
            pair_ok = pairs.has(grams.keys[1]) & word_ok
            for n in range(1, LONGEST_PHRASE + 1):
                begin = grams.at(n)
                begin = begin[word_ok[begin]]
                for k in range(n - 1):
                    begin = begin[pair_ok[begin + k]]
                _, sums, where = _summed(grams.keys[n - 1][begin], grams.weight[begin])
                begin = begin[where]
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.take(pa.array(grams.lang[begin])),
                        pa.array(np.full(len(begin), n, np.int32)),
                        pa.array(_spelled(grams, begin, n), pa.binary()).cast(pa.string()),
                        pa.array(sums),
                    ],
                    names=["lang", "size", "phrase", "f"],
                )

    counted = chunks.select("lang", "own", "chunk", "n").mapInArrow(count, "lang string, size int, phrase string, f long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _spelled(grams: Grams, begin: np.ndarray, n: int) -> list[bytes]:
    """Words of the phrases, space-joined."""
    view, parts = memoryview(grams.data), []
    for k in range(n):
        at = begin + k
        parts.append([bytes(view[a:b]) for a, b in zip(grams.words.start[at].tolist(), grams.words.end[at].tolist())])
    return parts[0] if n == 1 else [b" ".join(x) for x in zip(*parts)]


def mine(docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP, period: int = PERIOD, longest: int = LONGEST, most_bits: int = MOST_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first phrases of every language by score.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its two parts at the cut with the least score
    ``floor(SCALE * a / (l + r))``, the first of equal ones; ``n`` counts the language's words.
    """
    chunks = dictionary(docs, period, longest)
    words = filter_of(stored(frequent_hashes(chunks, 1, least), "words"), most_bits)
    pairs = filter_of(stored(frequent_hashes(chunks, 2, least, words), "pairs"), most_bits)
    table = stored(phrases(chunks, words, pairs, least), "phrases")
    return rank(scored(table), totals(chunks), top)


def totals(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("lang").agg(F.sum(F.col("n") * F.col("own")).alias("n"))


def scored(table: DataFrame) -> DataFrame:
    """Candidates that no longer phrase covers, with the cut that counts: ``lang, phrase, a, l, r, score``."""
    spelled = F.split("phrase", " ")
    span = lambda a, n: F.array_join(F.slice("words", a, n), " ")
    long = table.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), spelled.alias("words"))
    # Every phrase of two words or more inside a longer one, with the most frequent that holds it.
    inside = long.where("size > 2").select("lang", "a", "size", "words", F.explode(F.expr("sequence(2, size - 1)")).alias("len"))
    inside = inside.select("lang", "a", "words", "len", F.explode(F.expr("sequence(1, size - len + 1)")).alias("at"))
    cover = inside.select("lang", span(F.col("at"), F.col("len")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    big = lambda c: F.col(c).cast("decimal(38,0)")
    open_ = long.join(cover, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * big("longer") < COVERED * big("a")))
    cuts = open_.select("lang", "phrase", "a", "words", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", span(F.lit(1), F.col("k")).alias("left"), span(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    counted = lambda name, f: table.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    valued = cuts.join(counted("left", "l"), ["lang", "left"]).join(counted("right", "r"), ["lang", "right"])
    score = F.expr(f"(CAST({SCALE} AS DECIMAL(20,0)) * CAST(a AS DECIMAL(18,0))) div (CAST(l AS DECIMAL(20,0)) + r)").alias("score")
    best = F.min(F.struct(score, "k", "l", "r")).alias("best")
    return valued.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def rank(found: DataFrame, words: DataFrame, top: int = TOP) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
