"""What the operators share: reading, the shared folder, bounded batches, rows in global order."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text that one step of a worker holds as Python objects, in bytes; a longer text is a step alone.
STEP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact(df: DataFrame, *names: str) -> DataFrame:
    """The columns of exactly these names; others that differ from them only in case do no harm."""
    inner = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return inner.select(*[F.col(f"c{df.columns.index(name)}").alias(name) for name in names])


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share: ``spark.checkpoint.dir``, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: no lineage, safe from lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def steps(batches: Iterable[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` has about ``limit`` bytes in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches cut into few rows each, where rows become Python objects that may be long."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def texts_of(column: pa.Array) -> list[str]:
    """Whole texts; null is the empty text."""
    return [x or "" for x in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """Whole texts as UTF-8; null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


@dataclass
class Ordered:
    """Rows in one global order: partitions in order, and sorted within."""

    rows: DataFrame
    parts: int


def in_order(docs: DataFrame, lookahead: bool = False) -> Ordered:
    """``docs`` by ascending ``doc_id`` (null first, equal ids by text) as ``part, ahead, doc_id, packed``.

    Only ``doc_id`` and ``text`` are read; ``packed`` is the whole text, compressed, so that the one
    exchange moves less. ``part`` counts the partitions in order, bounds come from a sketch of
    ``doc_id`` alone, and there are as many as the session's shuffle partitions. With ``lookahead``
    every partition ends with copies, marked ``ahead``, of the rows that have the id which follows
    its own (after the last: the first).
    """
    spark = docs.sparkSession
    docs = exact(docs, "doc_id", "text")
    n = shuffle_partitions(spark)
    probabilities = [i / n for i in range(n)]
    found = docs.agg(
        F.percentile_approx("doc_id", probabilities, 10_000).alias("q"),
        F.min("doc_id").alias("low"),
        F.max(F.col("doc_id").isNull()).alias("nulls"),
    ).first()
    low = [] if found.low is None else [found.low]
    bounds = np.array(sorted({*low, *(found.q or [])}), np.int64)
    nulls = bool(found.nulls)

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in steps(batches, "text"):
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            values = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
            part = np.where(known, np.searchsorted(bounds, values, "right") - 1, 0).astype(np.int32)
            part = np.maximum(part, 0)
            texts = pa.array([squeeze.compress(x) for x in bytes_of(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(np.zeros(len(part), bool)), ids, texts], names=names
            )
            if lookahead:
                first = ~known if nulls else known & (values == bounds[0])
                at = known & (part > 0) & (values == bounds[part]) if len(bounds) else np.zeros(len(part), bool)
                copy = np.flatnonzero(first | at)
                if len(copy):
                    to = np.where(first[copy], max(len(bounds) - 1, 0), part[copy] - 1).astype(np.int32)
                    rows = pa.array(copy)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(to), pa.array(np.ones(len(copy), bool)), ids.take(rows), texts.take(rows)], names=names
                    )

    names = ["part", "ahead", "doc_id", "packed"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        pack, "part int, ahead boolean, doc_id long, packed binary"
    )
    parts = max(len(bounds), 1)
    rows = rows.repartitionById(parts, "part").sortWithinPartitions(
        "ahead", F.col("doc_id").asc_nulls_first(), "packed"
    )
    return Ordered(rows, parts)


def unpacked(column: pa.Array) -> list[bytes]:
    """Whole texts as UTF-8."""
    expand = zstandard.ZstdDecompressor()
    return [expand.decompress(x) for x in column.to_pylist()]


def sample(df: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """At most ``n`` rows, those with the least hash of ``key``: a bounded sample to fit a model on.

    The bound on the hash comes from the keys alone, so that whole rows are sorted for few of them.
    """
    order = F.xxhash64(F.lit(0), F.col(key))
    least = df.select(order.alias("h")).orderBy("h").limit(n).agg(F.max("h").alias("h")).first()
    return df.where(order <= F.lit(least.h)).orderBy(order, *df.columns).limit(n)


def labelled(docs: DataFrame, labels: DataFrame, column: str, per_class: int) -> tuple[DataFrame, dict[int, float]]:
    """At most ``per_class`` documents of each label 0 and 1, as ``doc_id, text, label``, to learn from.

    Rows of fold 0 and null labels are never taken. The second value weighs each class so that the
    sample counts as the labels are spread. The joined side is bounded by ``2 * per_class`` rows.
    """
    docs, labels = exact(docs, "doc_id", "text"), exact(labels, "doc_id", column)
    known = labels.select("doc_id", F.col(column).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0)
    )
    total = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [sample(known.where(F.col("label") == y), per_class) for y in sorted(total)]
    weights = {y: total[y] / sum(total.values()) / (min(total[y], per_class) / sum(min(n, per_class) for n in total.values())) for y in total}
    if not parts:
        return docs.select("doc_id", "text", F.lit(0).alias("label")).limit(0), weights
    chosen = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # One label for each id, so that a repeated label row does not repeat its document.
    chosen = chosen.groupBy("doc_id").agg(F.max("label").alias("label"))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), weights


def keep_rows(docs: DataFrame, start: Callable[[], Callable[[list[str]], np.ndarray]], limit: int = STEP_BYTES) -> DataFrame:
    """The rows, with all their columns, whose whole text is accepted; nothing is shuffled.

    ``start()`` runs once in a task and gives the function that says which of some texts to keep.
    """
    place = docs.columns.index("text")
    names = [f"c{i}" for i in range(len(docs.columns))]

    def run(batches):
        accept = start()
        for batch in steps(batches, names[place], limit):
            yield batch.filter(pa.array(np.asarray(accept(texts_of(batch.column(place))), bool)))

    # Positional names inside, so that columns whose names differ only in case do no harm.
    inner = docs.toDF(*names)
    return inner.mapInArrow(run, inner.schema).toDF(*docs.columns)
