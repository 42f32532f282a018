"""Exact duplicates by two passes of Bloom filtering, with DataFrame functions alone.

Texts are equal when they are identical after every run of ASCII white space (the space and
``\\x09-\\x0D``) has become one space. Of equal texts the row with the smallest ``doc_id`` stays.

1. One scan writes a digest of every text, 64 letters, to the shared folder; texts are never shuffled.
2. First pass: every digest sets two positions of a filter. Positions travel, summed before the
   shuffle, and those that were set more than once become the bits of a second filter.
3. Second pass: the second filter is broadcast, and a digest with a position that was set once is
   alone: its row is finished where it was read. Only the other rows, possibly repeated, are grouped.

The filter has 16 to 32 bits for each row and at most ``MOST_BITS``, so the broadcast is at most
128 MB. Past that size more rows are grouped needlessly, and the result is the same.

Groups of more than a thousandth of all rows are fewer than a thousand, and are broadcast to their
rows; so no key with many rows is ever brought together.

Odd input: a null text counts as empty. A null ``doc_id`` counts as larger than all others, and
``keep_id`` is null only where all ids of a group are. Of rows that repeat both id and text one
stays. Further columns make no difference, also those whose names differ only in case. An empty
table gives no rows. The length of a text has no limit but that of a Spark value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickrow.llm.common import exact, stored

#: Bits that Spark's bitmap functions keep in one value.
_BUCKET_BITS = 1 << 15
BITS_PER_ROW = 16
MOST_BITS = 1 << 30
#: A group with more than this share of the rows is broadcast instead of shuffled.
HOT_SHARE = 1 / 1000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    """sha256 of the normalised text in UTF-8, in lowercase hex."""
    return F.sha2(normalised(text).cast("binary"), 256)


def digests(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text_sha256`` of every row, written once; ``row`` numbers are unique."""
    rows = exact(docs, "doc_id", "text").select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("text_sha256")
    )
    return stored(rows, "digests")


def buckets_for(n_rows: int, most_bits: int = MOST_BITS) -> int:
    """Buckets of a filter for so many rows: a power of two."""
    wanted = max(1, min(n_rows * BITS_PER_ROW, most_bits) // _BUCKET_BITS)
    return 1 << (wanted - 1).bit_length()


def _places(rows: DataFrame, buckets: int) -> DataFrame:
    """The rows with their bucket and their two positions in it, from separate bits of one hash."""
    h = F.xxhash64("text_sha256")
    part = lambda shift: F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(_BUCKET_BITS - 1)).cast("int")
    return rows.select("*", h.bitwiseAND(F.lit(buckets - 1)).cast("int").alias("bucket"), part(16).alias("p1"), part(31).alias("p2"))


def repeated_filter(rows: DataFrame, buckets: int) -> DataFrame:
    """First pass: ``bucket, bits`` with the positions that were set more than once."""
    positions = _places(rows, buckets).select("bucket", F.explode(F.array("p1", "p2")).alias("position"))
    again = positions.groupBy("bucket", "position").agg(F.count("*").alias("n")).where("n > 1")
    return again.groupBy("bucket").agg(F.bitmap_construct_agg(F.col("position").cast("long")).alias("bits"))


def _is_set(bits: Column, position: Column) -> Column:
    octet = F.conv(F.hex(F.substring(bits, F.shiftright(position, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.bit_get(octet, position.bitwiseAND(F.lit(7))) == 1


def tested(rows: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Second pass: the rows with ``maybe``, false where the digest is surely alone. No row moves."""
    found = _places(rows, buckets).join(F.broadcast(filters), "bucket", "left")
    both = _is_set(F.col("bits"), F.col("p1")) & _is_set(F.col("bits"), F.col("p2"))
    return found.select(*rows.columns, F.coalesce(both, F.lit(False)).alias("maybe"))


def judge(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row, dropped ones too."""
    rows = digests(docs)
    n_rows = rows.count()
    buckets = buckets_for(n_rows, most_bits)
    marked = tested(rows, repeated_filter(rows, buckets), buckets)
    alone = marked.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    repeated = marked.where("maybe").select("row", "doc_id", "text_sha256")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")).alias("first")
    groups = stored(repeated.groupBy("text_sha256").agg(F.count("*").alias("group_size"), first), "groups")
    hot = F.col("group_size") > n_rows * HOT_SHARE
    large = repeated.join(F.broadcast(groups.where(hot)), "text_sha256", "left")
    small = large.where("group_size IS NULL").select(*repeated.columns).join(groups.where(~hot), "text_sha256")
    grouped = large.where("group_size IS NOT NULL").unionByName(small).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256"
    )
    return alone.unionByName(grouped)


def unique(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Only ids and digests of dropped rows meet the texts. Rows that repeat id and text are one if
    they are equal in all columns; else the smallest by all columns in order stays.
    """
    verdicts = judge(docs)
    names = [f"c{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*names)
    key = [f"c{docs.columns.index('doc_id')}", f"c{docs.columns.index('text')}"]
    keyed = inner.select("*", F.coalesce(F.col(key[0]).cast("string"), F.lit("")).alias("id"), digest(F.col(key[1])).alias("sha"))
    named = verdicts.groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text_sha256").alias("sha"))
    counts = stored(named.agg(F.count("*").alias("n"), F.max("kept").alias("stays")).where("n > 1 OR NOT stays"), "verdicts")
    whole = keyed.join(counts.select("id", "sha"), ["id", "sha"], "left_anti").select(*names)
    again = keyed.join(counts.where("stays").select("id", "sha"), ["id", "sha"], "left_semi")
    one = again.groupBy("id", "sha").agg(F.min(F.struct(*names)).alias("row")).select("row.*")
    return whole.unionByName(one).toDF(*docs.columns)
