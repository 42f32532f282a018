"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are a document's words (lower case, letters only) and their first four to six letters. The
vocabulary has all terms of the examples, with document frequencies over all documents. Examples are held
in an inverted index by term, in blocks with the greatest weight of each: a query adds up the postings of
its rare terms, then those of the common ones in the blocks that can hold one of the nearest, and cosines
of the few that remain are computed exactly.

A second index has the same vectors cut to a lexicon: terms whose document frequencies over the examples
differ between the two labels by ``SURE`` (chi-square) and by a factor of ``LIFT`` (rates), at most the
``TERMS`` surest. It finds a few telling words in a long text. A lexicon may be empty; the first
index needs none.

The neighbours in both vote for their label with weight cosine squared (times the class weight, as the
sample is balanced by label). The share of toxic votes is turned into a probability by isotonic regression
over the examples' own shares, each found without itself. A text with no term of the vocabulary is near no
example and gets the rate of toxic documents among the examples that are like it. The ids of the
neighbours over all terms are returned as evidence.

The index has at most ``PER_CLASS`` examples of each label, learned only from rows outside fold 0;
every document is scored over its whole text.

Null and empty texts have no terms. Repeated rows get equal scores. Ties among neighbours go to the
smaller example number. Without labels every score is 0; with one label only, near that label. An
empty table gives no rows. Only ``doc_id`` and ``text`` are inputs of a score.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickrow.llm.collocations import LOWER, Powers, Words, words_of
from brickrow.llm.common import exact, fold, labelled, slices, steps, stored, texts_of

PER_CLASS = 2000
TERMS = 3000
SURE = 30.0
LIFT = 6.0
NEAREST = 15
THRESHOLD = 0.5
#: Votes that the rate of the empty neighbourhood has in every share.
PRIOR_VOTES = 0.5
#: Text that one step scores, in bytes.
STEP = 1 << 19
#: Texts that are looked up together.
TOGETHER = 160
#: Examples that one task calibrates.
EXAMPLES = 512
#: Places of words whose terms a task keeps, a power of two, and the most terms that such a word may have.
KEPT_WORDS, KEPT_TERMS = 1 << 17, 4

#: Terms whose hashes are computed at once.
TABLE_STEP = 10_000

#: How many first letters of a word are terms too.
BEGINNINGS = (4, 5, 6)

_LETTERS = re.compile(r"[^\W\d_]+")
_IS_LETTER = np.zeros(256, np.int64)
_IS_LETTER[[*b"abcdefghijklmnopqrstuvwxyz"]] = 1


def terms_of(word: str) -> list[str]:
    """Terms of one word."""
    out = []
    for w in _LETTERS.findall(word.lower()):
        out.append(w)
        out += [f"{w[:n]}*" for n in BEGINNINGS if len(w) >= n]
    return out


class Terms:
    """Numbers of the terms in texts, all texts at once.

    Words are cut and told apart as bytes. Terms are looked up by 64-bit hashes, so that workers get no
    vocabulary of strings. What a word's terms are is kept by its hash, in as many places as ``KEPT_WORDS``: a
    later word takes the place of an earlier one.
    """

    def __init__(self, vocabulary: dict[str, int]) -> None:
        self.size = len(vocabulary)
        self.whole = self._table(vocabulary, False)
        self.beginnings = self._table(vocabulary, True)
        self._keep_nothing()

    def _keep_nothing(self) -> None:
        self.powers = Powers()
        # A place that is free has a hash that belongs elsewhere.
        self.kept = np.arange(KEPT_WORDS, dtype=np.uint64) ^ np.uint64(1)
        self.kept_numbers = np.full((KEPT_WORDS, KEPT_TERMS), -1, np.int32)

    def __getstate__(self) -> dict:
        return {k: getattr(self, k) for k in ("size", "whole", "beginnings")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._keep_nothing()

    def fresh(self) -> Terms:
        """The same terms with no words kept, for one task."""
        out = Terms.__new__(Terms)
        out.__setstate__(self.__getstate__())
        return out

    @staticmethod
    def _table(vocabulary: dict[str, int], beginnings: bool) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the terms of one kind, ascending, and their numbers."""
        hashes, numbers, powers = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], Powers()
        terms = ((t.removesuffix("*").encode(), n) for t, n in vocabulary.items() if (t[-1] == "*") == beginnings)
        # Few at a time: powers are kept for the longest run of bytes that was hashed at once.
        while some := list(islice(terms, TABLE_STEP)):
            offsets = np.concatenate([[0], np.cumsum([len(t) for t, _ in some])]).astype(np.int64)
            hashes.append(words_of(b"".join([t for t, _ in some]), offsets, powers).hash)
            numbers.append(np.array([n for _, n in some], np.int32))
        hashes, numbers = np.concatenate(hashes), np.concatenate(numbers)
        order = np.argsort(hashes, kind="stable")
        return hashes[order], numbers[order]

    @staticmethod
    def _found(table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> np.ndarray:
        """Numbers of the hashes in a table, -1 for those that are not there."""
        keys, numbers = table
        if not len(keys):
            return np.full(len(hashes), -1, np.int32)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[at] == hashes, numbers[at], np.int32(-1))

    def _of_other(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For words of more than ASCII letters: which word, and the number of one of its terms, -1 for none."""
        text = b"\n".join(words).decode().lower()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kinds, kind = np.unique(points, return_inverse=True)
        letter = np.array([_LETTERS.match(chr(x)) is not None for x in kinds.tolist()], np.int8)[kind]
        edge = np.diff(letter, prepend=np.int8(0), append=np.int8(0))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        word = np.cumsum(points == 10)[start]
        data = text.encode()
        # Where each code point lies in the bytes.
        at = np.zeros(len(points) + 1, np.int64)
        np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000), out=at[1:])
        hashed = words_of(data, np.array([0, len(data)]), self.powers)
        which, numbers = [word], [self._found(self.whole, hashed.hash_of(at[start], at[end], self.powers))]
        for n in BEGINNINGS:
            long = np.flatnonzero(end - start >= n)
            which.append(word[long])
            numbers.append(self._found(self.beginnings, hashed.hash_of(at[start[long]], at[start[long] + n], self.powers)))
        return np.concatenate(which), np.concatenate(numbers)

    def _of_words(self, data: bytes, words: Words, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the words at ``first``: which of these, and the number of one of its terms, by word."""
        start, end = words.start[first], words.end[first]
        letters = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_IS_LETTER[np.frombuffer(data, np.uint8)], out=letters[1:])
        is_plain = letters[end] - letters[start] == end - start
        plain, other = np.flatnonzero(is_plain), np.flatnonzero(~is_plain)
        which, numbers = [plain], [self._found(self.whole, words.hash[first[plain]])]
        for n in BEGINNINGS:
            long = plain[end[plain] - start[plain] >= n]
            which.append(long)
            numbers.append(self._found(self.beginnings, words.hash_of(start[long], start[long] + n, self.powers)))
        if len(other):
            of, more = self._of_other([data[a:b] for a, b in zip(start[other].tolist(), end[other].tolist())])
            which.append(other[of])
            numbers.append(more)
        which, numbers = np.concatenate(which), np.concatenate(numbers)
        there = numbers >= 0
        which, numbers = which[there], numbers[there]
        order = np.argsort(which, kind="stable")
        return which[order], numbers[order]

    def _keep(self, hashes: np.ndarray, begin: np.ndarray, numbers: np.ndarray) -> None:
        """Distinct words with the ends of their terms in ``numbers``; one that has more than there is room for is not kept."""
        some = np.flatnonzero(np.diff(begin) <= KEPT_TERMS)
        place, one = np.unique((hashes[some] & np.uint64(KEPT_WORDS - 1)).astype(np.int64), return_index=True)
        some = some[one]
        size = np.diff(begin)[some]
        self.kept[place] = hashes[some]
        for i in range(KEPT_TERMS):
            at = np.minimum(begin[some] + i, max(len(numbers) - 1, 0))
            self.kept_numbers[place, i] = np.where(size > i, numbers[at], np.int32(-1)) if len(numbers) else -1

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term and how often it occurs there, ascending by text and term."""
        encoded = [t.encode().translate(LOWER) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in encoded])]).astype(np.int64)
        data = b"".join(encoded)
        words = words_of(data, offsets, self.powers)
        n = max(self.size, 1)
        base = words.owner * n
        place = (words.hash & np.uint64(KEPT_WORDS - 1)).astype(np.int64)
        known = self.kept[place] == words.hash
        found = self.kept_numbers[place[known]]
        keys = [(base[known, None] + found)[found >= 0]]
        new = np.flatnonzero(~known)
        if len(new):
            hashes, first, which = np.unique(words.hash[new], return_index=True, return_inverse=True)
            owner, numbers = self._of_words(data, words, new[first])
            begin = np.searchsorted(owner, np.arange(len(hashes) + 1))
            at, times = spans(begin[which], begin[which + 1])
            keys.append(np.repeat(base[new], times) + numbers[at])
            self._keep(hashes, begin, numbers)
        key = np.sort(np.concatenate(keys))
        cut = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        count = np.diff(cut, append=len(key))
        return key[cut] // n, key[cut] % n, count

    def counted(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its terms, ascending, and how often each occurs."""
        owner, term, count = self.rows(texts)
        cut = np.searchsorted(owner, np.arange(len(texts) + 1))
        return [(term[a:b], count[a:b]) for a, b in zip(cut, cut[1:])]


def unit(w: np.ndarray) -> np.ndarray:
    return w / np.sqrt((w * w).sum()) if len(w) else w


def weighed(t: np.ndarray, times: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers, and their weights as a vector of length 1."""
    return t, unit((1 + np.log(times)) * idf[t])


#: Examples of a block.
BLOCK = 64
#: Queries whose rare terms are added up at once.
ADDED = 8
#: What sums of single precision may be off by: 2 ** -24 for each of some 2,000 terms, and more.
SLACK = 2e-4


def spans(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each ``a`` up to its ``b``, one after the other, and how many each gives."""
    size = b - a
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(a - (end - size), size), size


class Index:
    """Postings of the examples by term, in blocks of examples with the greatest weight of each block.

    Examples are ordered so that similar ones share a block. Terms that many examples have are common:
    their blocks are dense, one matrix for each block, and ``most`` has the greatest weight of every term in
    every block. The others have lists of the examples that have them.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int):
        self.size, self.terms = len(vectors), terms
        # Inside, terms are numbered by how many examples have them, and lie in this order in every vector.
        have = np.zeros(terms, np.int32)
        for t, _ in vectors:
            have[t] += 1
        self.back = np.argsort(-have, kind="stable").astype(np.int32)
        self.rank = np.empty(terms, np.int32)
        self.rank[self.back] = np.arange(terms, dtype=np.int32)
        self.have = have[self.back]
        self.begin = np.concatenate([[0], np.cumsum([len(t) for t, _ in vectors], dtype=np.int64)]).astype(np.int64)
        self.term, self.weight = np.empty(self.begin[-1], np.int32), np.empty(self.begin[-1])
        for (t, w), a, b in zip(vectors, self.begin, self.begin[1:]):
            rank = self.rank[t]
            order = np.argsort(rank)
            self.term[a:b], self.weight[a:b] = rank[order], w[order]
        self._built = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_built": None}  # workers build the blocks themselves

    def _blocks(self) -> dict:
        if self._built is None:
            owner = np.repeat(np.arange(self.size, dtype=np.int32), np.diff(self.begin))
            common = int((self.have > max(self.size // 16, 8)).sum())
            there = self.term < common
            some, whose, weight = self.term[there], owner[there], self.weight[there].astype(np.float32)
            dense = np.zeros((common, self.size), np.float32)
            dense[some, whose] = weight
            # Similar examples lie on the same side of the directions in which all differ most. The mean is taken
            # from the products, as a centred or a wider copy of the matrix would be as large again.
            mean = dense.mean(1, keepdims=True) if self.size else np.zeros((common, 1), np.float32)
            basis = np.eye(common, min(4, common), dtype=np.float32)
            for _ in range(6):
                along = dense.T @ basis - mean.T @ basis
                basis = np.linalg.qr(dense @ along - mean * along.sum(0))[0]
            along = dense.T @ basis - mean.T @ basis
            sides = (along > 0) @ (1 << np.arange(along.shape[1])) if common else np.zeros(self.size)
            order = np.lexsort((along[:, 0] if common else np.zeros(self.size), sides))
            position = np.empty(self.size, np.int32)
            position[order] = np.arange(self.size, dtype=np.int32)
            n = -(-self.size // BLOCK)
            del dense
            blocks = np.zeros((n, common, BLOCK), np.float32)
            place = position[whose]
            blocks[place // BLOCK, some, place % BLOCK] = weight
            del some, whose, weight, place
            rare = np.flatnonzero(~there)
            rare = rare[np.argsort(self.term[rare], kind="stable")]
            self._built = {
                "common": common,
                "blocks": blocks,
                "most": np.ascontiguousarray(blocks.max(2).T),
                "order": order,
                "position": position,
                "start": np.searchsorted(self.term[rare], np.arange(self.terms + 1, dtype=np.int32)),
                "places": position[owner[rare]],
                "weights": self.weight[rare],
                "head": self.begin[:-1] + np.bincount(owner[there], minlength=self.size),
                "query": np.zeros(common),
            }
        return self._built

    def vector(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.begin[i : i + 2]
        return self.back[self.term[a:b]], self.weight[a:b]

    def release(self) -> None:
        """Gives up the blocks; a further query builds them again."""
        self._built = None

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the ``k`` nearest examples with a cosine over 0, nearest first."""
        return self.nearest_of([(t, w)], k, [without])[0]

    def nearest_of(self, queries: list[tuple], k: int, without: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each query.

        Sums over rare terms and, block by block, over common ones, the latter in single precision; a block that
        by its greatest weights cannot reach the ``k``-th so far is left out. For the few that may be among the
        nearest the common ones are then added up exactly.
        """
        if not self.size or not queries:
            return [(np.zeros(0, np.int64), np.zeros(0)) for _ in queries]
        x = self._blocks()
        n, wide = len(x["blocks"]), len(x["blocks"]) * BLOCK
        common = np.zeros((len(queries), x["blocks"].shape[1]), np.float32)
        rare = np.zeros((len(queries), wide))
        for a in range(0, len(queries), ADDED):
            some = queries[a : a + ADDED]
            owner = np.repeat(np.arange(len(some)), [len(t) for t, _ in some])
            t, w = (np.concatenate(parts) for parts in zip(*some))
            rank = self.rank[t]
            here, few = np.flatnonzero(rank < x["common"]), np.flatnonzero(rank >= x["common"])
            common[a + owner[here], rank[here]] = w[here]
            rows, size = spans(x["start"][rank[few]], x["start"][rank[few] + 1])
            place = np.repeat(owner[few] * wide, size) + x["places"][rows]
            added = np.bincount(place, x["weights"][rows] * np.repeat(w[few], size), len(some) * wide)
            rare[a : a + ADDED] = added.reshape(len(some), wide)
        sums = rare.astype(np.float32)
        for q, i in enumerate(without or []):
            if i >= 0:
                sums[q, x["position"][i]] = -np.inf
        bound = sums.reshape(len(queries), n, BLOCK).max(2) + common @ x["most"]
        seen = np.zeros((len(queries), n), bool)

        def add(wanted: np.ndarray) -> None:
            for block in np.flatnonzero(wanted.any(0)):
                rows = np.flatnonzero(wanted[:, block])
                sums[rows, block * BLOCK : (block + 1) * BLOCK] += common[rows] @ x["blocks"][block]
            seen[wanted] = True

        def reached(values: np.ndarray) -> np.ndarray:
            at = max(values.shape[1] - k, 0)
            return np.partition(values, at, axis=1)[:, at]

        most = min(n, -(-(k + 1) // BLOCK) + 1)
        first = np.argpartition(-bound, most - 1, axis=1)[:, :most]
        best = np.zeros_like(seen)
        np.put_along_axis(best, first, True, axis=1)
        add(best)
        of_first = np.take_along_axis(sums.reshape(len(queries), n, BLOCK), first[:, :, None], axis=1)
        add(~seen & (bound >= reached(of_first.reshape(len(queries), -1))[:, None] - SLACK))
        self.left_out = int((~seen).sum())
        sums.reshape(len(queries), n, BLOCK)[~seen] = -1
        values = sums
        least = np.maximum(reached(values) - SLACK, np.finfo(np.float32).tiny)
        return [self._exact(t, w, rare[q], np.flatnonzero(values[q] >= least[q]), k) for q, (t, w) in enumerate(queries)]

    def _exact(self, t: np.ndarray, w: np.ndarray, rare: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest of the examples at some places; ``rare`` has what the rare terms give at every place."""
        if not len(places):
            return np.zeros(0, np.int64), np.zeros(0)
        x = self._blocks()
        query, rank, some = x["query"], self.rank[t], x["order"][places]
        shared = rank < x["common"]
        query[:] = 0
        query[rank[shared]] = w[shared]
        begin, end = self.begin[some], x["head"][some]
        lists = list(zip(begin.tolist(), end.tolist()))
        products = query[np.concatenate([self.term[a:b] for a, b in lists])]
        products *= np.concatenate([self.weight[a:b] for a, b in lists])
        cosines = rare[places] + np.bincount(np.repeat(np.arange(len(some)), end - begin), products, len(some))
        # Cosines that differ by rounding only are ties.
        first = np.lexsort((some, -cosines.round(9)))[:k]
        return some[first], cosines[first]


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing step heights by pooling neighbours that are out of order: places and values."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b, w in zip(x[order], y[order], weight[order]):
        if blocks and blocks[-1][3] == a:
            last = blocks[-1]
            last[0] += b * w
            last[1] += w
        else:
            blocks.append([b * w, w, a, a])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, _, high = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][3] = high
    return np.array([(b[2] + b[3]) / 2 for b in blocks]), np.array([b[0] / b[1] for b in blocks])


@dataclass
class Model:
    #: On the driver; workers have hashes of the terms.
    vocabulary: dict[str, int]
    terms: Terms
    idf: np.ndarray
    index: Index
    #: Which terms are in the lexicon, and the examples' vectors cut to it.
    lexicon: np.ndarray
    told: Index
    ids: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    rate: float
    places: np.ndarray
    values: np.ndarray

    def __getstate__(self) -> dict:
        return {**self.__dict__, "vocabulary": {}}

    def shares(self, queries: list[tuple], without: list[int] | None = None) -> list[tuple[float, np.ndarray]]:
        """Weighted share of toxic votes, where the rate of texts without terms has some too; the nearest over all terms."""
        near = self.index.nearest_of(queries, NEAREST, without)
        cut = [(t[self.lexicon[t]], unit(w[self.lexicon[t]])) for t, w in queries]
        out = []
        for (ids, cosines), (more, telling) in zip(near, self.told.nearest_of(cut, NEAREST, without)):
            both = np.concatenate([ids, more])
            vote = np.concatenate([cosines, telling]) ** 2 * self.weights[both]
            out.append((float(((vote * self.labels[both]).sum() + PRIOR_VOTES * self.rate) / (vote.sum() + PRIOR_VOTES)), ids))
        return out

    def score(self, texts: list[str], known: dict) -> list[tuple[float, list[int]]]:
        """Score and evidence of each text; ``known`` is a task's, and keeps what it has looked up."""
        terms = known.get("terms") or known.setdefault("terms", self.terms.fresh())
        seen: dict[str, tuple[float, list[int]]] = {}
        asked = list(dict.fromkeys(texts))
        found = terms.counted(asked)
        for a in range(0, len(asked), TOGETHER):
            queries = {}
            for text, (t, times) in zip(asked[a : a + TOGETHER], found[a : a + TOGETHER]):
                if len(t):
                    queries[text] = weighed(t, times, self.idf)
                else:
                    seen[text] = (self.rate, [])
            for text, (share, ids) in zip(queries, self.shares(list(queries.values()))):
                seen[text] = (float(np.interp(share, self.places, self.values)), self.ids[ids].tolist())
        return [seen[text] for text in texts]


def frequencies(docs: DataFrame, known: Terms) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each term of the vocabulary."""
    given = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        terms = given.value.fresh()
        n, found = 0, np.zeros(terms.size, np.int64)
        for batch in steps(batches, "text", STEP):
            n += batch.num_rows
            found += np.bincount(terms.rows(texts_of(batch.column("text")))[1], minlength=len(found))
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(found[some], n))], names=["term", "n"])

    total = exact(docs, "text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(known.size + 1, np.int64)
    out[total["term"].to_numpy()] = total["n"].to_numpy()
    given.destroy()
    return int(out[-1]), out[:-1]


def calibrated(spark: SparkSession, model: Model) -> np.ndarray:
    """The share of toxic votes of every example, found without itself; the blocks are built in the tasks."""
    given = spark.sparkContext.broadcast(model)

    def run(batches):
        own = given.value
        for batch in slices(batches, TOGETHER):
            numbers = batch.column("id").to_pylist()
            found = own.shares([own.index.vector(i) for i in numbers], numbers)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([s for s, _ in found], pa.float64())], names=["id", "share"])
        # A worker that waits for another task keeps what was broadcast, beside those that score.
        own.index.release()
        own.told.release()

    examples = spark.range(0, model.index.size, 1, -(-model.index.size // EXAMPLES))
    found = examples.mapInArrow(run, "id long, share double").toArrow().sort_by("id")
    given.destroy()
    return found["share"].to_numpy()


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Vocabulary, index and calibration from at most ``2 * per_class`` examples."""
    rows, class_weight = labelled(docs, labels, column, per_class)
    # Copies of a text are one example, and an id with several documents must not exceed the bound.
    once = rows.groupBy("text", "label").agg(F.min(F.col("doc_id").cast("long")).alias("doc_id"))
    examples = stored(once.select("doc_id", "text", "label").limit(4 * per_class), "examples")

    def words(batches):
        for batch in steps(batches, "text"):
            y = batch.column("label").to_pylist()
            pairs = [(t, k) for text, k in zip(texts_of(batch.column("text")), y) for t in {t for w in text.split() for t in terms_of(w)}]
            if pairs:
                term, y = zip(*pairs)
                yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(y, pa.int32())], names=["term", "label"])

    totals = {r.label: r.n for r in examples.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    n = n1 + n0
    none, nothing = Index([], 0), np.zeros(0)
    if not n1 or not n0:
        rate = (n1 + 0.5) / (n + 1) if n else 0.0
        return Model({}, Terms({}), nothing, none, np.zeros(0, bool), none, np.zeros(0, np.int64), nothing, nothing, rate, np.zeros(1), np.zeros(1))
    a, b = F.sum("label"), F.sum(1 - F.col("label"))
    frequency = examples.mapInArrow(words, "term string, label int").groupBy("term").agg(a.alias("a"), b.alias("b"))
    # As many rows as the examples have terms.
    found = frequency.toArrow().sort_by("term")
    a, b = (found[c].to_numpy().astype(float) for c in "ab")
    lead = a * n0 - b * n1
    chi = n * lead * lead / ((a + b) * (n - (a + b) + 1) * float(n1 * n0))
    rate1, rate0 = (a + 0.5) / (n1 + 1), (b + 0.5) / (n0 + 1)
    apart = np.flatnonzero((chi >= SURE) & ((rate1 >= LIFT * rate0) | (rate0 >= LIFT * rate1)))
    lexicon = np.zeros(len(chi), bool)
    lexicon[apart[np.argsort(-chi[apart], kind="stable")[:TERMS]]] = True
    vocabulary = {t: i for i, t in enumerate(found["term"].to_pylist())}
    known = Terms(vocabulary)
    count, with_term = frequencies(docs, known)
    idf = np.log((1 + count) / (1 + with_term)) + 1
    given = docs.sparkSession.sparkContext.broadcast(known)

    def vectors(batches):
        terms = given.value.fresh()
        for batch in steps(batches, "text"):
            found = terms.counted(texts_of(batch.column("text")))
            kind = pa.list_(pa.int64())
            columns = [pa.array([f[i] for f in found], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *columns], names=names)

    names = ["doc_id", "label", "terms", "times"]
    schema = "doc_id long, label int, terms array<bigint>, times array<bigint>"
    rows = examples.mapInArrow(vectors, schema).toArrow().combine_chunks()
    given.destroy()
    ids, label = (rows[c].to_numpy() for c in ("doc_id", "label"))
    counts = [tuple(x.values.to_numpy() for x in pair) for pair in zip(rows["terms"], rows["times"])]
    # Terms decide only between rows with the same id and label.
    alike = Counter(zip(ids.tolist(), label.tolist()))
    held = sorted(
        range(len(ids)),
        key=lambda i: (ids[i], label[i], *(x.tobytes() for x in counts[i] if alike[int(ids[i]), int(label[i])] > 1)),
    )
    y = label[held].astype(float)
    weight = np.array([class_weight[int(k)] for k in y])
    vectors_ = [weighed(*counts[i], idf) for i in held]
    told = [(t[lexicon[t]], unit(w[lexicon[t]])) for t, w in vectors_]
    empty = np.array([not len(t) for t, _ in vectors_])
    rate = float(((y * weight)[empty].sum() + 0.5 * class_weight[1] * n1 / n) / (weight[empty].sum() + 0.5))
    indexes = Index(vectors_, len(idf)), lexicon, Index(told, len(idf))
    model = Model(vocabulary, known, idf, *indexes, ids[held], y, weight, rate, np.zeros(1), np.zeros(1))
    del rows, counts, vectors_, told
    shares = calibrated(docs.sparkSession, model)
    some = ~empty
    if some.any():
        model.places, model.values = isotonic(shares[some], y[some], weight[some])
    return model


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and ``evidence``, the ids of the nearest examples, nearest first."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known: dict = {}
        for batch in steps(batches, "text", STEP):
            scored = given.value.score(texts_of(batch.column("text")), known)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([s for s, _ in scored], pa.float64()),
                    pa.array([e for _, e in scored], pa.list_(pa.int64())),
                ],
                names=["doc_id", "score", "evidence"],
            )

    rows = exact(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, evidence array<bigint>"
    )
    return rows.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "evidence",
    )
