"""CSV files with line breaks inside quotes, read by several tasks.

A line belongs to a quoted field when an odd number of quotes lies before it, so where records begin follows
from counting quotes: each block of a file tells the parity of its own, the parities of the blocks before it
say whether its first line is inside a record, and then every block finds its records by itself. A record
that reaches over the end of a block is put together from its pieces; only those move, two a block at most.

Files must be as :func:`brickrow.sources.tables.write_csv` writes them: a field that holds a quote is
quoted, and quotes in it are doubled. Their header is one line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Pieces: a whole record, one that goes on in the next block, a block that is all one record's, its end.
WHOLE, OPEN, MIDDLE, END = range(4)
#: Blocks whose parities are broadcast, about 100 bytes each; beyond, lines are shuffled to them.
BROADCAST_BLOCKS = 200_000

_PIECE = "file string, block long, kind int, line string"
_ORDER = ["file", "block", "row"]


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, row, value``: the lines of all files, by the block of the file that they begin in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def inside_at(lines: DataFrame) -> DataFrame:
    """``file, block, inside``: whether a block's first line is inside a record. One row for each block."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    parity = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return parity.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the blocks, whose lines come one after the other; the first record of a file is its header."""
    at, held, quoted, reaches_in, header = None, [], False, False, False

    def left() -> list[tuple]:
        return [(*at, MIDDLE if reaches_in else OPEN, "\n".join(held))] if held else []

    for batch in batches:
        files, blocks, inside, lines = (c.to_pylist() for c in batch.columns)
        odd = (np.asarray(pc.count_substring(batch.column(3), '"')) % 2 == 1).tolist()
        out = []
        for i, line in enumerate(lines):
            if (files[i], blocks[i]) != at:
                out += left()
                at, held, header = (files[i], blocks[i]), [], blocks[i] == 0
                quoted = reaches_in = inside[i]
            held.append(line)
            quoted ^= odd[i]
            if not quoted:
                if not header:
                    out.append((*at, END if reaches_in else WHOLE, "\n".join(held)))
                held, reaches_in, header = [], False, False
        if out:
            yield _batch(out)
    if last := left():
        yield _batch(last)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["file", "block", "kind", "line"])


def records_of(lines: DataFrame, broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """``line``: every record of the files, without their headers; line breaks inside are ``\\n``."""
    starts = inside_at(lines)
    if starts.count() <= broadcast_blocks:
        known = lines.join(F.broadcast(starts), ["file", "block"])  # lines stay in their order
    else:
        n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        known = lines.join(starts, ["file", "block"]).repartition(n, "file", "block").sortWithinPartitions(*_ORDER)
    pieces = known.select("file", "block", "inside", "value").mapInArrow(_cut, _PIECE)
    parts = pieces.where(F.col("kind") != WHOLE)
    # The end of a record comes before the beginning of the next one in a block.
    order = Window.partitionBy("file").orderBy("block", (F.col("kind") == OPEN).cast("int"))
    numbered = parts.withColumn("nth", F.sum((F.col("kind") == OPEN).cast("int")).over(order))
    joined = numbered.groupBy("file", "nth").agg(F.array_sort(F.collect_list(F.struct("block", "line"))).alias("parts"))
    crossing = joined.select(F.array_join(F.col("parts.line"), "\n").alias("line"))
    return pieces.where(F.col("kind") == WHOLE).select("line").unionByName(crossing)


def read_records(spark: SparkSession, path: str, options: dict) -> DataFrame:
    """The files under ``path`` as a table of texts; ``options`` as for Spark's own CSV reader."""
    names = spark.read.options(**options).csv(path).columns
    schema = ", ".join(f"`{name}` string" for name in names)
    lines = records_of(lines_of(spark, path)).withColumn("line", F.regexp_replace("line", "\r(?=\n|$)", ""))
    # A line without any character is no record for the CSV reader either.
    told = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if k != "header"}
    return lines.where("line <> ''").select(F.from_csv("line", schema, told).alias("row")).select("row.*")
