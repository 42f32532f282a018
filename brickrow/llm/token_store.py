"""Token ids as directly addressable codes: any token by position, without decoding a block.

An id is cut into chunks from its low bits up. Level 0 has the lowest chunk of every id, level k the
next chunk of those that need one. A bitmap in each level marks which ids go on, and a rank directory
counts the marks before every 512th position, so that the place in the next level is one count and at
most eight words away. Chunk widths are chosen for each shard from the bit lengths of its ids.

``write`` puts a table of shards into a folder: whole documents in ascending order of ``doc_id``,
one binary value (the format below) and its documents' ids and lengths in a row. ``documents`` reads
them back, ``token`` gives the token at a position of the corpus.

Binary value: b"DAC1", count, number of levels (unsigned 32-bit), then for each level width and count
(unsigned 32-bit), packed chunks, bitmap, directory (unsigned 32-bit), each padded to 8 bytes.

Null texts are empty. A null ``doc_id`` comes first; rows of equal id are kept, ordered by text. A
document without ids has length 0 unless an end id is appended. An empty table gives no shards. Only
``doc_id`` and ``text`` are read, so further columns, whatever their names, make no difference.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brickrow.llm.common import in_order, steps, unpacked
from brickrow.llm.encoding import STEP, encoder

#: Tokens after which a shard is closed; a longer document is a shard of its own.
SHARD_TOKENS = 1 << 18
BLOCK = 512
#: Chunk widths to choose from: those that fill bytes evenly.
WIDTHS = (1, 2, 4, 8, 16)
LEVEL = 0.5

SHARDS = "part int, seq int, first long, n_tokens long, doc_ids array<bigint>, lengths array<bigint>, codes binary"


def widths(ids: np.ndarray) -> list[int]:
    """Chunk widths, lowest first, of least cost, by dynamic programming over bit lengths.

    An id costs its chunk, its mark, and ``LEVEL`` bits for the time that a further level takes.
    """
    if not len(ids):
        return [1]
    bits = np.maximum(np.frexp(ids.astype(float))[1], 1)
    top = int(bits.max())
    over = len(ids) - np.cumsum(np.bincount(bits, minlength=top + 1))  # ids that have more than b bits
    over[0] = len(ids)
    best: list[tuple[float, list[int]]] = [(0, [])] * (top + 1)
    for a in range(top - 1, -1, -1):
        rest = [(w, best[min(a + w, top)]) for w in WIDTHS]
        best[a] = min(((int(over[a]) * (w + 1 + LEVEL) + cost, [w, *plan]) for w, (cost, plan) in rest), key=lambda x: (x[0], len(x[1])))
    return best[0][1]


def _pad(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def _pack(values: np.ndarray, width: int) -> bytes:
    if width >= 8:
        return values.astype(f"<u{width // 8}").tobytes()
    each = 8 // width
    parts = np.zeros((-(-len(values) // each) * each), np.uint8)
    parts[: len(values)] = values
    out = parts[::each].copy()
    for k in range(1, each):
        out |= parts[k::each] << np.uint8(k * width)
    return out.tobytes()


def _unpack(data: bytes, width: int, count: int) -> np.ndarray:
    if width >= 8:
        return np.frombuffer(data, f"<u{width // 8}", count).astype(np.uint32)
    each = 8 // width
    packed = np.frombuffer(data, np.uint8)
    out = np.empty(len(packed) * each, np.uint8)
    for k in range(each):
        out[k::each] = (packed >> np.uint8(k * width)) & np.uint8((1 << width) - 1)
    return out[:count].astype(np.uint32)


def build(ids: np.ndarray) -> bytes:
    ids = ids.astype(np.uint32)
    plan = widths(ids)
    out = [b"DAC1", struct.pack("<II", len(ids), len(plan)), bytes(4)]
    rest = ids
    for k, width in enumerate(plan):
        chunk = rest & np.uint32((1 << width) - 1)
        rest = rest >> np.uint32(width)
        # An id goes on where higher chunks are not all zero; the last level ends every id.
        more = rest > 0
        marks = np.packbits(more.astype(np.uint8), bitorder="little").tobytes()
        starts = np.concatenate([[0], np.cumsum(more)])[: len(more) + 1 : BLOCK].astype("<u4").tobytes()
        out += [struct.pack("<II", width, len(chunk)), _pad(_pack(chunk, width)), _pad(marks), _pad(starts)]
        rest = rest[more]
    return b"".join(out)


def _levels(data: bytes) -> list[tuple[int, int, int, int, int]]:
    """Width, count and the places of chunks, bitmap and directory."""
    if data[:4] != b"DAC1":
        raise ValueError("not a shard of directly addressable codes")
    n, levels = struct.unpack_from("<II", data, 4)
    at, out = 16, []
    for _ in range(levels):
        width, count = struct.unpack_from("<II", data, at)
        chunks = at + 8
        marks = chunks + -(-width * count // 64) * 8
        starts = marks + -(-count // 64) * 8
        out.append((width, count, chunks, marks, starts))
        at = starts + -(-4 * (count // BLOCK + 1) // 8) * 8
    return out


def decode(data: bytes) -> np.ndarray:
    """All ids of a shard."""
    value, shift, at = None, 0, None
    for width, count, chunks, marks, _ in _levels(data):
        part = _unpack(data[chunks : chunks + -(-width * count // 8)], width, count)
        more = np.unpackbits(np.frombuffer(data, np.uint8, -(-count // 8), marks), count=count, bitorder="little")
        if value is None:
            value, at = part, np.arange(count)
        else:
            value[at] |= part << np.uint32(shift)
        shift += width
        at = at[more.astype(bool)]
    return value


def access(data: bytes, i: int) -> int:
    """The id at place ``i`` of a shard; reads one chunk and one rank for each level that it has."""
    value = shift = 0
    for width, count, chunks, marks, starts in _levels(data):
        if not 0 <= i < count:
            raise IndexError(i)
        bit = i * width
        window = int.from_bytes(data[chunks + bit // 8 : chunks + (bit + width + 7) // 8], "little")
        value |= ((window >> bit % 8) & ((1 << width) - 1)) << shift
        shift += width
        if not data[marks + i // 8] >> i % 8 & 1:
            break
        (before,) = struct.unpack_from("<I", data, starts + 4 * (i // BLOCK))
        base = i // BLOCK * BLOCK
        run = int.from_bytes(data[marks + base // 8 : marks + i // 8 + 1], "little") & ((1 << i - base) - 1)
        i = before + run.bit_count()
    return value


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 0) -> str:
    """Encode ``docs`` and write the shards under ``path``. One exchange, of compressed texts."""

    def shards(batches):
        words = encoder(tokenizer)
        end = b"" if end_id is None else struct.pack("<I", end_id)
        part, seq, first, held, ids, lengths, parts = 0, 0, 0, 0, [], [], []

        def shard():
            row = [[part], [seq], [first], [held], [ids], [lengths], [build(np.frombuffer(b"".join(parts), "<u4"))]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(row, kinds)],
                names=["part", "seq", "first", "n_tokens", "doc_ids", "lengths", "codes"],
            )

        for batch in steps(batches, "packed", STEP // 2):  # of compressed texts
            part = batch.column("part")[0].as_py()
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), words.encode(unpacked(batch.column("packed")))):
                ids.append(doc_id)
                lengths.append(len(data + end) // 4)
                parts.append(data + end)
                held += lengths[-1]
                if held >= SHARD_TOKENS:
                    yield shard()
                    seq, first, held, ids, lengths, parts = seq + 1, first + held, 0, [], [], []
        if ids:
            yield shard()

    in_order(docs).rows.mapInArrow(shards, SHARDS).write.option("compression", "zstd").option(
        "parquet.block.size", 32 << 20
    ).parquet(path)
    return path


def shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the tokens of the corpus before each.

    The sum runs over one row for each partition of the writer, a count that does not depend on the rows.
    """
    read = spark.read.schema(SHARDS).parquet(path)
    sizes = read.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("part_start"))
    return read.join(F.broadcast(starts), "part").withColumn("start", F.col("part_start") + F.col("first"))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Every document as read from the shards: ``doc_id, start, n_tokens, ids`` (ids little-endian unsigned 32-bit)."""

    def read(batches):
        names = ["doc_id", "start", "n_tokens", "ids"]
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                ids = decode(row["codes"]).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["start"] + ends - lengths),
                        pa.array(lengths),
                        pa.array([ids[e - n : e].tobytes() for e, n in zip(ends, lengths)], pa.binary()),
                    ],
                    names=names,
                )

    columns = shards(spark, path).select("start", "doc_ids", "lengths", "codes")
    return columns.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def token(spark: SparkSession, path: str, position: int) -> int | None:
    """The token at a position of the corpus, null beyond its end. Reads one shard's codes."""
    at = F.lit(position)
    hit = shards(spark, path).where((F.col("start") <= at) & (at < F.col("start") + F.col("n_tokens")))
    row = hit.select("start", "codes").first()
    return None if row is None else access(row.codes, position - row.start)


def checksums(docs: DataFrame) -> DataFrame:
    """``ids_crc32`` for the rows of ``documents``."""
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
