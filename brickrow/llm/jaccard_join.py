"""Links between documents whose sets of word shingles have a Jaccard similarity of 0.75 or more.

Method: a partition of the universe and the pigeonhole principle. Two linked sets of sizes ``s >= l``
differ in at most ``(s + l) / 7`` elements. Sets fall into bands of sizes (powers of two). A band's
universe is cut by hash into segments, and of two linked sets at least one of any ``2 s / 7 + 1`` whole
segments is equal. A record therefore indexes all its segments that are not empty (in its band, and in
the next if it is large enough to be linked there) and need only probe ``2 s / 7 + 1`` of its own.
Which ones is decided by cost: after one exchange of the segments' signatures, those that no other
record has cost nothing and find nothing; of the others a record probes only as many as are lacking,
those with the fewest members first. A document without near copies probes none.

Small sets may have fewer segments than they need. Below ``SMALL`` elements, segments also index every
set with one element deleted; probing a segment and its one-deletion neighbourhood finds a difference
of up to one there and counts twice. A record that still lacks segments is compared with every record
of a size that it could be linked with.

Candidates are not expanded into all pairs of a group. First every probing record is compared with one
member of each bucket; verified links give components; then records are compared only with members of
other components, as lists, one row for each record and block of members. Comparison is exact in two
steps: parities of the elements' hashes in ``BITS`` places differ in no more places than the sets do,
which rules out most; the others' sets are compared element by element.

Where links are to be counted (``counted``), one pass does both: every record is compared with the blocks
of all that it shares a probed bucket with, one row for each record and block, and of the links that
are counted those that span the block go on to the components. Without counts (``spanning``), links between
sets of one component are not looked for.

Null and empty texts have no shingle and are linked with nothing. Exact copies are one record and not
expanded. Rows of an equal or null ``doc_id`` are rows of their own; a component's id is the smallest
known ``doc_id`` in it. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickrow.llm.common import exact as exact_columns
from brickrow.llm.common import shuffle_partitions, slices, steps, stored, texts_of
from brickrow.llm.components import components
from brickrow.llm.shingles import mix, shingles

#: Links have 100 * intersection >= 75 * union, that is at most (s + l) / SHARE differences.
SHARE = 7
#: Sets of fewer elements index one-deletion neighbourhoods too.
SMALL = 32
#: Places of the parity sketch.
BITS = 1024
#: Elements of the smallest sets that others can be linked with: 3 of 4. Smaller sets only equal ones match.
LEAST = 3
#: Members of a bucket that are counted; more cost the same.
COUNTED = 1 << 16
#: Members of a piece of a bucket.
PIECE = 4096
#: Members of a block that lists of candidates are sent to.
TOGETHER = 256
#: Words of the filter that keeps sets of other documents at home: 64 bits each, a fixed 2 MB.
FILTER = 1 << 18

_ODD = np.uint64(0x9E3779B97F4A7C15)
_OWN, _NEAR = 1, 2  # flags in a signature's low byte: the record's own band, a one-deletion neighbour


def required(n: int) -> int:
    """Segments that a record has to probe."""
    return 2 * n // SHARE + 1


def segments(band: int, most: int | None = None) -> int:
    """Segments of a band of sizes under ``2 ** (band + 1)``: a tenth more than its largest set needs, as some stay empty.

    ``most`` sets fewer, down to one; records then lack segments, which only costs time.
    """
    if most:
        return most
    need = required(2 ** (band + 1) - 1)
    return need if 2 ** (band + 1) <= SMALL else need + need // 10 + 3


def _band(band: int) -> np.uint64:
    return np.uint64(band * int(_ODD) % 2**64)


def cut(x: np.ndarray, band: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Elements' segments and hashes in a band; the segments that are not empty, and their sizes."""
    g = mix(x + _band(band))
    n = segments(band, most)
    at = ((g >> np.uint64(32)) % np.uint64(n)).astype(np.int64)
    size = np.bincount(at, minlength=n)
    some = np.flatnonzero(size)
    return at, mix(g + _ODD), some, size[some]


def named(total: np.ndarray, segment: np.ndarray, band: int) -> np.ndarray:
    """Signatures of subsets, given by the sums of their elements' hashes; the low byte is free for flags."""
    return mix(mix(total) + segment.astype(np.uint64) * _ODD + _band(band)) & ~np.uint64(255)


def signatures(x: np.ndarray, most: int | None = None) -> np.ndarray:
    """All index entries of a set of at least ``LEAST`` elements."""
    n, own = len(x), len(x).bit_length() - 1
    out = []
    for band in (own, own + 1):
        if band > own and 4 * n < 3 * 2**band:
            continue
        flag = np.uint64(_OWN if band == own else 0)
        at, h, some, size = cut(x, band, most)
        total = np.zeros(segments(band, most), np.uint64)
        np.add.at(total, at, h)
        out.append(named(total[some], some, band) | flag)
        if 2 ** (band + 1) <= SMALL:
            less = np.flatnonzero(np.bincount(at)[at] > 1)
            out.append(named(total[at[less]] - h[less], at[less], band) | flag | np.uint64(_NEAR))
    return np.concatenate(out)


def sketch(x: np.ndarray) -> bytes:
    """Parities of the elements in each of ``BITS`` places."""
    odd = np.bincount((mix(x + np.uint64(77)) & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def key_of(x: np.ndarray) -> bytes:
    return hashlib.blake2b(x.tobytes(), digest_size=16).digest()


def _number(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def described(docs: DataFrame, most: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, key, rec, segs, twos, sketch``; ``key`` names the set and is null without shingles."""

    def run(batches):
        names = ["doc_id", "n_shingles", "key", "rec", "segs", "twos", "sketch"]
        for batch in steps(batches, "text", 1 << 20):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
                x = shingles(text)
                n = len(x)
                segs = twos = 0
                if n >= LEAST:
                    _, _, _, size = cut(x, n.bit_length() - 1, most)
                    segs, twos = len(size), int((size > 1).sum()) if n < SMALL else 0
                key = key_of(x) if n else None
                rec = _number(key) if n else None
                rows.append((doc_id, n, key, rec, segs, twos, sketch(x) if n >= LEAST else None))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    rows = exact_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_shingles long, key binary, rec long, segs int, twos int, sketch binary")


def entries(docs: DataFrame, most: int | None = None) -> DataFrame:
    """Index entries ``sig, rec`` of every set, once for each task; ``rec`` is the first half of its key.

    A document's entries follow each other, so that the exchange stores its ``rec`` once for each target.
    """

    def run(batches):
        seen: set[int] = set()
        for batch in steps(batches, "text", 1 << 20):
            sigs, recs = [], []
            for text in texts_of(batch.column("text")):
                x = shingles(text)
                if len(x) < LEAST:
                    continue  # these are linked only with equal sets
                rec = _number(key_of(x))
                if rec not in seen:
                    seen.add(rec)
                    sigs.append(signatures(x, most))
                    recs.append(np.full(len(sigs[-1]), rec, np.int64))
            if sigs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(recs))], names=["sig", "rec"]
                )

    return exact_columns(docs, "text").mapInArrow(run, "sig long, rec long")


def shared(index: DataFrame) -> DataFrame:
    """Entries of buckets that two records or more are in, and that one of them may probe: ``bucket, rec, flags, cost``.

    Entries come sorted and are counted as they pass, so memory does not grow with a bucket.
    """

    def emit(sig: np.ndarray, rec: np.ndarray, many: bool = False):
        bucket = sig >> 8
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        length = np.diff(first, append=len(sig))
        rows = np.flatnonzero(np.repeat((length > 1) | many, length))  # the rest have no company
        sig, rec = sig[rows], rec[rows]
        order = np.lexsort((sig, rec, sig >> 8))
        sig, rec = sig[order], rec[order]
        new = np.ones(len(sig), bool)  # the same record from two tasks is one
        new[1:] = (sig[1:] != sig[:-1]) | (rec[1:] != rec[:-1])
        sig, rec = sig[new], rec[new]
        bucket = sig >> 8
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(sig) else np.zeros(0, np.int64)
        length = np.diff(first, append=len(sig))
        if len(first) and not many:
            others = rec[first] != np.maximum.reduceat(rec, first)
            own = np.bitwise_or.reduceat(sig & _OWN, first) > 0
            take = np.repeat(others & own, length)
        else:
            take = np.ones(len(sig), bool)
        cost = np.repeat(np.minimum(length, COUNTED) if not many else np.full(len(first), COUNTED), length)
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[take]), pa.array(rec[take]), pa.array((sig[take] & 255).astype(np.int32)), pa.array(cost[take].astype(np.int32))],
            names=["bucket", "rec", "flags", "cost"],
        )

    def run(batches):
        sig, rec, open_ = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            sig = np.concatenate([sig, batch.column(0).to_numpy()])
            rec = np.concatenate([rec, batch.column(1).to_numpy()])
            if not len(sig):
                continue
            if open_ is not None:  # a bucket too long to hold goes on
                end = int(np.searchsorted(sig >> 8, open_, "right"))
                if end:
                    yield emit(sig[:end], rec[:end], many=True)
                sig, rec = sig[end:], rec[end:]
                if not len(sig):
                    continue
                open_ = None
            last = int(np.searchsorted(sig >> 8, sig[-1] >> 8, "left"))
            if last:
                yield emit(sig[:last], rec[:last])
                sig, rec = sig[last:], rec[last:]
            if len(sig) > COUNTED:
                yield emit(sig, rec, many=True)
                open_ = sig[-1] >> 8
                sig, rec = sig[:0], rec[:0]
        if len(sig):
            yield emit(sig, rec)

    n = shuffle_partitions(index.sparkSession)
    dealt = index.repartition(n, F.shiftright("sig", 8)).sortWithinPartitions("sig")
    return dealt.mapInArrow(run, "bucket long, rec long, flags int, cost int")


def probes(entries_: DataFrame, records: DataFrame) -> DataFrame:
    """``bucket, node`` that records have to probe: what they lack beyond entries of their own, the cheapest first."""
    need = F.floor(2 * F.col("n") / SHARE) + 1
    own = entries_.where(F.col("flags").bitwiseAND(_OWN) > 0).join(records.select("rec", "node", "n", "segs"), "rec")
    whole = F.col("flags").bitwiseAND(_NEAR) == 0
    by = Window.partitionBy("node")
    ranked = (
        own.withColumn("common", F.sum(whole.cast("int")).over(by))
        .withColumn("nth", F.row_number().over(by.orderBy((~whole).cast("int"), "cost", "bucket")))
        .withColumn("lack", need - (F.col("segs") - F.col("common")))
    )
    # Too few segments: all that is shared is probed, one-deletion neighbours too.
    few = F.col("segs") < need
    return ranked.where(few | (whole & (F.col("nth") <= F.col("lack")))).select("bucket", "node").distinct()


def members(entries_: DataFrame, records: DataFrame, probed: DataFrame) -> DataFrame:
    """``bucket, part, parts, node, n, probe, block, degree`` of everything in the buckets that are probed.

    ``part`` cuts a bucket into pieces of about ``PIECE`` members. ``block`` groups records that are
    often in one bucket: by the least member of their buckets, in pieces of about ``TOGETHER``.
    ``degree`` counts a record's buckets: of near copies, the one that differs least from the others has most.
    """
    inside = entries_.select("bucket", "rec").join(probed.select("bucket").distinct(), "bucket", "left_semi")
    known = inside.join(records.select("rec", "node", "n"), "rec").select("bucket", "node", "n").distinct()
    marked = known.join(probed.withColumn("probe", F.lit(True)), ["bucket", "node"], "left")
    rows = stored(marked.select("bucket", "node", "n", F.coalesce("probe", F.lit(False)).alias("probe")), "inside")
    least = rows.groupBy("bucket").agg(
        F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("least"), F.ceil(F.count("*") / PIECE).alias("parts")
    )
    both = rows.join(least, "bucket")
    lead = both.groupBy("node").agg(F.min("least").alias("lead"), F.count("*").alias("degree"))
    lead = lead.select("node", F.col("lead.node").alias("lead"), "degree")
    sizes = lead.groupBy("lead").agg(F.ceil(F.count("*") / TOGETHER).alias("blocks"))
    block = F.xxhash64("lead", F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("block")
    part = F.pmod(F.xxhash64(F.lit(1), "node"), F.col("parts")).alias("part")
    return both.join(lead.join(sizes, "lead").select("node", block, "degree"), "node").select(
        "bucket", part, "parts", "node", "n", "probe", "block", "degree"
    )


def candidates(rows: DataFrame, every: bool) -> DataFrame:
    """``x``, list of ``y`` and list of their blocks, for probing records and pieces of buckets: what may be linked.

    ``rows``: as ``members``, and ``root``. ``every``: all members of another component that are not larger;
    a piece is read in the order of sizes, and only members within reach of the next size are held.
    Else one member of the piece within reach, the one that is in most buckets.
    """
    columns = ["bucket", "part", "n", "node", "block", "root", "ask"]
    if every:
        held = rows.withColumn("ask", F.lit(False))
        each = rows.where("probe").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        rows = held.select(columns).unionByName(each.withColumn("ask", F.lit(True)).select(columns))
        order = ["n", "node", "ask"]
    else:
        rows = rows.withColumn("ask", F.col("probe")).select(*columns, "degree")
        order = [F.desc("degree"), F.xxhash64("node"), "node"]

    def all_of_others(piece: list, n: int, node: int, block: int, root: int, ask: bool):
        if not ask:
            piece.append((n, node, block, root))
            return None
        while piece and 4 * piece[0][0] < 3 * n:
            piece.popleft()
        # Members of equal size come in the order of their numbers; the later one asks.
        return [h for h in piece if h[3] != root and (h[0], h[1]) < (n, node)]

    def one_in_reach(piece: list, n: int, node: int, block: int, root: int, ask: bool):
        found = next((h for h in piece if 4 * min(h[0], n) >= 3 * max(h[0], n)), None)
        if found is None:
            piece.append((n, node, block, root))  # a bucket's sizes differ by a factor under 3: a few at most
            return None
        return [found] if ask else None

    answer = all_of_others if every else one_in_reach

    def run(batches):
        last, piece = None, deque()
        for batch in slices(batches):
            out = []
            for bucket, part, n, node, block, root, ask in zip(*(c.to_pylist() for c in batch.columns)):
                if (bucket, part) != last:
                    last, piece = (bucket, part), deque()
                some = answer(piece, n, node, block, root, ask)
                if some:
                    out.append((node, [h[1] for h in some], [h[2] for h in some]))
            if out:
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["x", "ys", "blocks"])

    n = shuffle_partitions(rows.sparkSession)
    dealt = rows.repartition(n, "bucket", "part").sortWithinPartitions("bucket", "part", *order).select(columns)
    return dealt.mapInArrow(run, "x long, ys array<bigint>, blocks array<bigint>")


def by_block(lists: DataFrame) -> DataFrame:
    """``x, block, ys``: what a record is compared with, once, by block."""

    def run(batches):
        last, held = None, {}

        def flush():
            blocks: dict[int, list] = {}
            for y, b in held.items():
                blocks.setdefault(b, []).append(y)
            return [(last, b, sorted(ys)) for b, ys in blocks.items()]

        for batch in slices(batches):
            out = []
            for x, ys, blocks in zip(*(c.to_pylist() for c in batch.columns)):
                if x != last:
                    if last is not None:
                        out += flush()
                    last, held = x, {}
                held.update(zip(ys, blocks))
            if out:
                yield _lists(out)
        if last is not None:
            yield _lists(flush())

    n = shuffle_partitions(lists.sparkSession)
    dealt = lists.select("x", "ys", "blocks").repartition(n, "x").sortWithinPartitions("x")
    return dealt.mapInArrow(run, "x long, block long, ys array<bigint>")


def _lists(rows: list[tuple]) -> pa.RecordBatch:
    """``x, block, ys`` and, if there is a fourth, ``n_links``."""
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["x", "block", "ys", "n_links"][: len(columns)])


def compared(lists: DataFrame, data: DataFrame, blocks: DataFrame, exact: bool, every: bool = False) -> DataFrame:
    """The rows of ``x, block, ys`` with the members that pass; without any, no row.

    With ``every``, ``n_links`` counts the members that pass and ``ys`` are those of them that the links
    of the block before have not joined with ``x`` already, which is all that components need.

    ``data``: ``node, n, data`` (sketches, or sets if ``exact``); ``blocks``: ``node, block, root``. A
    block's members are read first, then the records that are compared with them pass by. Components that
    exact links of the same block have joined already are not compared again, unless ``every`` link is
    to be counted. Null ``ys`` are all members of the block.
    """
    held = data.join(blocks, "node").select(
        "block", F.lit(0).alias("turn"), F.col("node").alias("x"), "n", "data", "root", F.lit(None).cast("array<bigint>").alias("ys")
    )
    roots = blocks.select(F.col("node").alias("x"), "root")
    asking = lists.join(data.withColumnRenamed("node", "x"), "x").join(roots, "x", "left").select(
        "block", F.lit(1).alias("turn"), "x", "n", "data", F.coalesce("root", "x").alias("root"), "ys"
    )

    def find(joined: dict[int, int], root: int) -> int:
        while joined.get(root, root) != root:
            root = joined[root]
        return root

    def run(batches):
        block, there, joined = None, {}, {}
        for batch in slices(batches):
            out = []
            for b, turn, x, n, blob, root, ys in zip(*(c.to_pylist() for c in batch.columns)):
                if b != block:
                    block, there, joined = b, {}, {}
                own = np.frombuffer(blob, np.uint64)
                if not turn:
                    there[x] = (n, own, root)
                    continue
                some = [y for y in ys if y in there] if ys is not None else [y for y in there if y != x]
                if not some:
                    continue
                if exact and every:
                    passed = [y for y in some if linked(own, there[y][1])]
                    kept = []
                    for y in passed:
                        mine, other = find(joined, root), find(joined, there[y][2])
                        if mine != other:
                            joined[mine] = other
                            kept.append(y)
                    if passed:
                        out.append((x, b, kept, len(passed)))
                    continue
                elif exact:
                    kept = []
                    for y in some:
                        mine, other = find(joined, root), find(joined, there[y][2])
                        if mine != other and linked(own, there[y][1]):
                            joined[mine] = other
                            kept.append(y)
                else:
                    differ = np.bitwise_count(np.stack([there[y][1] for y in some]) ^ own).sum(1)
                    most = (np.array([there[y][0] for y in some]) + n) // SHARE
                    kept = [y for y, near in zip(some, differ <= most) if near]
                if kept:
                    out.append((x, b, kept))
            if out:
                yield _lists(out)

    n = shuffle_partitions(lists.sparkSession)
    dealt = held.unionByName(asking).repartition(n, "block").sortWithinPartitions("block", "turn")
    return dealt.mapInArrow(run, "x long, block long, ys array<bigint>" + (", n_links long" if every else ""))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union, for ascending sets."""
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= 75 * (len(a) + len(b) - common)


class Filter:
    """Which documents may be among some given ones, by three bits of a table of fixed size for each id."""

    def __init__(self, given: DataFrame):
        place = given.select(F.explode(F.array(*self.columns(F.col("doc_id")))).alias("h"))
        bits = place.select(F.shiftrightunsigned("h", 46).alias("word"), F.expr("shiftleft(1L, int(h & 63))").alias("bit"))
        found = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most FILTER rows
        words = np.zeros(FILTER, np.int64)
        words[found["word"].to_numpy()] = found["bits"].to_numpy()
        self.words = given.sparkSession.sparkContext.broadcast(words.tobytes())

    @staticmethod
    def columns(doc_id: Column) -> list[Column]:
        """The hashes that ``hit`` looks up; a null id is an id like others."""
        return [F.xxhash64(F.lit(k), doc_id.cast("long")).alias(f"filter_{k}") for k in (1, 2, 3)]

    def hit(self, batch: pa.RecordBatch) -> pa.Array:
        bits = np.frombuffer(self.words.value, np.int64)
        keep = np.ones(batch.num_rows, bool)
        for k in (1, 2, 3):
            h = batch.column(f"filter_{k}").to_numpy()
            keep &= (bits[(h.view(np.uint64) >> np.uint64(46)).astype(np.int64)] >> (h & 63)) & 1 == 1
        return pa.array(keep)


def sets_of(docs: DataFrame, records: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, n, data`` with the whole sets of the wanted nodes.

    A filter of fixed size, of the wanted records' documents, decides which texts are looked at; the
    few others that pass are dropped by the join.
    """
    mine = records.join(wanted, "node", "left_semi").select("node", "key", "doc_id")
    near = Filter(mine)

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            for part in steps([batch.filter(near.hit(batch))], "text", 1 << 20):
                rows = []
                for text in texts_of(part.column("text")):
                    x = shingles(text)
                    if len(x) >= LEAST and (key := key_of(x)) not in seen:
                        seen.add(key)
                        rows.append((key, len(x), x.tobytes()))
                if rows:
                    kinds = [pa.binary(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["key", "n", "data"])

    hashed = exact_columns(docs, "doc_id", "text").select("text", *Filter.columns(F.col("doc_id")))
    rows = hashed.mapInArrow(run, "key binary, n long, data binary").join(mine.select("node", "key"), "key")
    return rows.groupBy("node").agg(F.first("n").alias("n"), F.first("data").alias("data"))


def confirmed(docs: DataFrame, records: DataFrame, lists: DataFrame, blocks: DataFrame, name: str) -> DataFrame:
    """``x, y`` that are linked, of candidate lists; ``blocks`` has block and root of every candidate."""
    sketches = records.select("node", "n", F.col("sketch").alias("data"))
    near = stored(compared(by_block(lists), sketches, blocks, False), f"{name}-near")
    sets = stored(sets_of(docs, records, stored(named_in(near).distinct(), f"{name}-ends")), f"{name}-sets")
    found = compared(near, sets, blocks, True)
    return stored(found.select("x", F.explode("ys").alias("y")), f"{name}-links")


def named_in(lists: DataFrame) -> DataFrame:
    """``node`` of every record that lists name, about once for each task."""

    def run(batches):
        met: set[int] = set()
        for batch in batches:
            new = set(pc.unique(batch.column(0)).to_pylist())
            new.update(pc.unique(batch.column(1).flatten()).to_pylist())
            new -= met
            if len(met) > 1_000_000:
                met = set()
            met |= new
            yield pa.RecordBatch.from_arrays([pa.array(sorted(new), pa.int64())], names=["node"])

    return lists.select("x", "ys").mapInArrow(run, "node long")


def lacking(records: DataFrame) -> DataFrame:
    """Candidate lists of records that have too few segments, also with one-deletion neighbours: all of a size in reach."""
    need = F.floor(2 * F.col("n") / SHARE) + 1
    short = records.where((F.col("n") >= LEAST) & (F.col("segs") + F.col("twos") < need))
    reach = F.sequence(F.ceil(0.75 * F.col("n")).cast("long"), F.col("n"))
    sizes = short.select(F.col("node").alias("x"), F.explode(reach).alias("n"))
    pairs = sizes.join(records.where(F.col("n") >= LEAST).select(F.col("node").alias("y"), "n"), "n").where("x != y")
    return pairs.select("x", F.array("y").alias("ys"), F.array(F.xxhash64("y")).alias("blocks"))


def meeting(*asked: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``node, block``, of each pair of tables: for records in buckets the blocks that others there are in.

    Most buckets of a large group have members of the same blocks. Such buckets are one set of blocks, named by
    two hashes, and a record meets each set once, however many of its buckets have it.
    """
    names, met, sets = ["set_1", "set_2"], [], []
    for asking, there in asked:
        of_bucket = there.groupBy("bucket").agg(F.sort_array(F.collect_set("block")).alias("blocks"))
        named = [F.xxhash64(F.lit(k), "blocks").alias(name) for k, name in enumerate(names, 1)]
        sets.append(stored(of_bucket.select("bucket", "blocks", *named), "block-sets"))
        met.append(asking.select("bucket", "node").join(sets[-1].select("bucket", *names), "bucket").select("node", *names))
    every, known = met[0], sets[0]
    for more, others in zip(met[1:], sets[1:]):
        every, known = every.unionByName(more), known.unionByName(others)
    once = known.groupBy(names).agg(F.first("blocks").alias("blocks"))
    return every.distinct().join(once.select(*names, F.explode("blocks").alias("block")), names).select("node", "block")


def counted(docs: DataFrame, records: DataFrame, inside: DataFrame, short: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``node, n_links``: with how many other sets a set is linked, and ``x, y``: links that span the components.

    Sets without links have no row. Of two sets that may be linked each asks for the other's block, so that a link counts once at both.
    ``inside``: as ``members``; ``short``: as ``lacking``.
    """
    own = inside.select("node", "block").distinct()
    blocks = records.select("node").join(own, "node", "left").withColumn("block", F.coalesce("block", F.xxhash64("node")))
    blocks = stored(blocks.withColumn("root", F.col("node")), "counted-blocks")
    rows = inside.select("bucket", "node", "block", "probe")
    probing = rows.where("probe")
    asks = meeting((probing, rows), (rows.where(~F.col("probe")), probing))
    pairs = short.select("x", F.explode("ys").alias("y"))
    for x, y in (("x", "y"), ("y", "x")):
        ends = pairs.select(F.col(x).alias("asking"), F.col(y).alias("node"))
        asks = asks.unionByName(ends.join(blocks, "node").select(F.col("asking").alias("node"), "block"))
    lists = asks.distinct().select(F.col("node").alias("x"), "block", F.lit(None).cast("array<bigint>").alias("ys"))
    lists = stored(lists, "counted-asks")
    used = blocks.join(lists.select("block").distinct(), "block", "left_semi").select("node", "block", "root")
    sketches = records.where(F.col("n") >= LEAST).select("node", "n", F.col("sketch").alias("data"))
    near = stored(compared(lists, sketches, used, False), "counted-near")
    sets = stored(sets_of(docs, records, stored(named_in(near).distinct(), "counted-ends")), "counted-sets")
    found = stored(compared(near, sets, used, True, every=True), "counted")
    counts = found.groupBy(F.col("x").alias("node")).agg(F.sum("n_links").alias("n_links"))
    return counts, found.select("x", F.explode("ys").alias("y"))


def spanning(docs: DataFrame, records: DataFrame, inside: DataFrame, short: DataFrame) -> DataFrame:
    """``x, y``: verified links that span the components, without those inside components found before.

    ``inside``: as ``members``; ``short``: as ``lacking``.
    """
    blocks = stored(inside.select("node", "block").distinct(), "blocks")
    single = blocks.withColumn("root", F.col("node"))
    links = confirmed(docs, records, candidates(inside.withColumn("root", F.col("node")), False), single, "first")
    roots = components(links, "x", "y")
    # Buckets whose members are in one component have nothing to add.
    rooted = inside.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a != b")
    rest = rooted.join(mixed.select("bucket"), "bucket", "left_semi")
    now = stored(rest.select("node", "block", "root").distinct(), "blocks")
    links = links.unionByName(confirmed(docs, records, candidates(rest, True), now, "second"))
    if not short.isEmpty():
        alone = short.select(F.explode("ys").alias("node")).distinct()
        alone = alone.withColumn("block", F.xxhash64("node")).withColumn("root", F.col("node"))
        links = links.unionByName(confirmed(docs, records, short, alone, "lacking"))
    return links


def classes(docs: DataFrame, most_segments: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row of ``docs``.

    ``n_links`` counts the other sets that the row's set is linked with, all of them.
    """
    return placed(docs, True, most_segments).select("doc_id", "n_shingles", "component_id", "n_links")


def representatives(docs: DataFrame) -> DataFrame:
    """``docs``, of every component one row: of its smallest ``doc_id``. Rows without shingles all stay.

    Only rows whose id may be among those to be dropped (``Filter``) are shuffled, for the exact answer.
    """
    rows = stored(placed(docs).where(F.col("key").isNotNull()).select("doc_id", "key", "root"), "placed")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key")
    kept = stored(rows.groupBy("root").agg(F.min(order).alias("kept")).select("kept.doc_id", "kept.key"), "kept")
    # Rows that are not the one kept, and the kept ones that are there more than once.
    times = rows.groupBy("doc_id", "key").agg(F.count("*").alias("times"))
    mark = kept.select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))
    doubtful = Filter(times.join(mark, same, "left").where(F.col("kept_key").isNull() | (F.col("times") > 1)).select("doc_id"))
    names = [f"c{i}" for i in range(len(docs.columns))]
    place = docs.columns.index("text")
    id_ = F.col(names[docs.columns.index("doc_id")])
    inner = docs.toDF(*names)
    hashed = inner.select("*", *Filter.columns(id_))

    def others(batches):
        for batch in batches:
            yield batch.filter(pc.invert(doubtful.hit(batch))).select(names)

    def asked(batches):
        for batch in batches:
            for part in steps([batch.filter(doubtful.hit(batch))], names[place], 1 << 20):
                sets = [shingles(t) for t in texts_of(part.column(place))]
                keys = pa.array([key_of(x) if len(x) else None for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.select(names).columns, keys], names=[*names, "key"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema)
    rest = hashed.mapInArrow(asked, f"{schema}, key binary")
    found = rest.join(mark, id_.cast("long").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key")))
    first = found.withColumn("nth", F.row_number().over(Window.partitionBy("key", "kept_id").orderBy("kept_key")))
    parts = [hashed.mapInArrow(others, schema), rest.where(F.col("key").isNull()).select(names), first.where("nth = 1").select(names)]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).toDF(*docs.columns)


def placed(docs: DataFrame, count: bool = False, most_segments: int | None = None) -> DataFrame:
    """Every row as ``doc_id, n_shingles, key, root, component_id, n_links``; ``root`` numbers the component.

    ``n_links`` is null unless they are to be counted, which components need not.
    """
    rows = stored(described(docs, most_segments), "described")
    known = rows.where(F.col("key").isNotNull())
    once = known.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"),
        F.first("n_shingles").alias("n"),
        *[F.first(c).alias(c) for c in ("rec", "segs", "twos", "sketch")],
    )
    records = stored(once.withColumn("node", F.monotonically_increasing_id()), "records")
    index = stored(shared(entries(docs, most_segments)), "shared")
    probed = stored(probes(index, records), "probes")
    inside = stored(members(index, records, probed), "members")
    short = stored(lacking(records), "lacking")
    if count:
        counts, links = counted(docs, records, inside, short)
    else:
        links = spanning(docs, records, inside, short)
    roots = components(links, "x", "y")
    least = records.join(roots, "node").groupBy("root").agg(F.min("doc_id").alias("least"))
    joined = roots.join(least, "root").select("node", "root", "least")
    n_links = F.lit(None).cast("long")
    if count:
        joined = joined.join(counts, "node", "left")
        n_links = F.coalesce("n_links", F.lit(0).cast("long"))
    final = records.join(joined, "node", "left").select(
        F.col("key").alias("key_"),
        F.coalesce("root", "node").alias("root"),
        F.coalesce("least", "doc_id").alias("component_id"),
        n_links.alias("n_links"),
    )
    columns = ["doc_id", "n_shingles", "key", "root", "component_id", "n_links"]
    out = known.join(final, F.col("key") == F.col("key_"), "left").select(columns)
    none = F.lit(None).cast("long").alias("root")
    empty = rows.where(F.col("key").isNull()).select(
        "doc_id", "n_shingles", "key", none, F.col("doc_id").alias("component_id"), F.lit(0 if count else None).cast("long").alias("n_links")
    )
    return out.unionByName(empty)
