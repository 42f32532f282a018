"""Quality rules with thresholds that adapt to each language and source.

Every document is measured (words, symbols, repeated lines, repeated words). For each language and
source, each measure has a quantile sketch: counts of values in bins whose edges grow by a fixed
factor, so any quantile is known within a relative error of ``(GROWTH - 1) / (GROWTH + 1)``. Sketches
merge by adding counts, as Spark's partial aggregation does; a source with fewer than ``least``
documents uses the merged sketch of its language. A document is kept if every measure lies within the
fence of its group: the quartiles, widened by ``SPREAD`` times their distance and at least by the
measure's slack, so that a group without spread does not lose its ordinary documents.

Documents that fail the base rules (under 50 words, or over half of the words in repeated three-word
windows) are not in the sketches and not kept.

Null texts have no words and fail the base rules. A null language or source is a group of its own.
Repeated rows count each time; a null ``doc_id`` is carried along. An empty table gives no rows. Only
``doc_id, text, lang, source`` are read, so further columns make no difference.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickrow.llm.common import exact, steps, stored, texts_of

#: Edges of neighbouring bins differ by this factor.
GROWTH = 1.02
#: Quartile distances by which the fence is wider than the quartiles.
SPREAD = 3.0
#: Documents that a language and source needs for thresholds of its own.
LEAST = 100
#: Copies of each threshold row in the join, so that a source with most rows spreads over tasks.
SALTS = 32

#: measure -> (numerator, slack, whether low values are suspect too). All are thousandths of ``n_words``.
MEASURES = {
    "word_length": ("word_chars", 2000, True),
    "symbols": ("n_symbols", 100, False),
    "dup_lines": ("n_dup_lines", 60, False),
    "repeats": ("n_repeat_words", 250, False),
}

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def measure(text: str) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one text."""
    data = text.encode()
    words = data.split()  # bytes split at exactly the six ASCII white-space characters
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        marks = bytearray(len(words))
        for i, x in enumerate(windows):
            if times[x] > 1:
                marks[i : i + 3] = b"\1\1\1"
        repeated = sum(marks)
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def measured(docs: DataFrame) -> DataFrame:
    names = ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for batch in steps(batches, "text"):
            values = list(zip(*map(measure, texts_of(batch.column("text")))))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names[:3]), *(pa.array(x, pa.int64()) for x in values)], names=names
            )

    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in names[3:])
    columns = [F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source"]
    rows = exact(docs, "doc_id", "text", "lang", "source").select(*columns).mapInArrow(run, schema)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def value(name: str) -> Column:
    """A measure in thousandths, rounded down; only for documents with words."""
    return F.floor(1000 * F.col(MEASURES[name][0]) / F.greatest(F.col("n_words"), F.lit(1)))


def bin_of(v: Column) -> Column:
    """Bin 0 has values under 1, bin b > 0 those from GROWTH^(b-1) on."""
    return F.when(v < 1, 0).otherwise(F.floor(F.log(v) / math.log(GROWTH)) + 1).cast("int")


def middle(b: Column) -> Column:
    """A value that stands for a bin."""
    return F.when(b < 1, 0.0).otherwise(2 * F.pow(F.lit(GROWTH), b) / (GROWTH + 1))


def sketches(rows: DataFrame) -> DataFrame:
    """``lang, source, measure, bin, n`` of the documents that pass the base rules. Sketches add up."""
    bins = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bin_of(value(m)).alias("bin")) for m in MEASURES]))
    passed = rows.where(~F.col("base_failed")).select("lang", "source", bins.alias("x"))
    return passed.groupBy("lang", "source", "x.measure", "x.bin").agg(F.count("*").alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """``n_docs, q1, q3`` for each group and measure."""
    group = Window.partitionBy(*keys, "measure")
    total = F.sum("n").over(group)
    upto = F.sum("n").over(group.orderBy("bin"))
    ranked = sketch.select(*keys, "measure", "bin", total.alias("n_docs"), upto.alias("upto"))

    def quantile(q: float) -> Column:
        return middle(F.min(F.when(F.col("upto") >= q * F.col("n_docs"), F.col("bin"))))

    return ranked.groupBy(*keys, "measure").agg(
        F.max("n_docs").alias("n_docs"), quantile(0.25).alias("q1"), quantile(0.75).alias("q3")
    )


def thresholds(sketch: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, source`` and for each measure ``low_*`` and ``high_*``; one row for each language and source."""
    own = quartiles(sketch, ["lang", "source"])
    merged = sketch.groupBy("lang", "measure", "bin").agg(F.sum("n").alias("n"))
    whole = quartiles(merged, ["lang"]).select(
        F.col("lang").alias("lang_"), F.col("measure").alias("measure_"), F.col("q1").alias("q1_"), F.col("q3").alias("q3_")
    )
    both = own.join(whole, F.col("lang").eqNullSafe(F.col("lang_")) & (F.col("measure") == F.col("measure_")))
    q1, q3 = (F.when(F.col("n_docs") >= least, F.col(c)).otherwise(F.col(f"{c}_")) for c in ("q1", "q3"))
    out = both.select("lang", "source", "measure", q1.alias("q1"), q3.alias("q3"))

    def fence(name: str) -> list[Column]:
        _, slack, two_sided = MEASURES[name]
        wide = F.greatest(SPREAD * (F.col("q3") - F.col("q1")), F.lit(float(slack)))
        low = F.col("q1") - wide if two_sided else F.lit(-1.0)
        return [
            F.max(F.when(F.col("measure") == name, low)).alias(f"low_{name}"),
            F.max(F.when(F.col("measure") == name, F.col("q3") + wide)).alias(f"high_{name}"),
        ]

    return out.groupBy("lang", "source").agg(*[c for m in MEASURES for c in fence(m)])


def judge(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Every document with its measures, ``base_failed`` and ``kept``."""
    rows = stored(measured(docs), "measures")  # read twice: for the sketches and for the verdict
    salted = thresholds(sketches(rows), least).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    limits = salted.select(
        F.col("lang").alias("lang_"), F.col("source").alias("source_"), "salt", *[f"{s}_{m}" for m in MEASURES for s in ("low", "high")]
    )
    left = rows.withColumn("salt_", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    same = (
        F.col("lang").eqNullSafe(F.col("lang_"))
        & F.col("source").eqNullSafe(F.col("source_"))
        & (F.col("salt_") == F.col("salt"))
    )
    inside = F.lit(True)
    for m in MEASURES:
        inside &= (value(m) >= F.col(f"low_{m}")) & (value(m) <= F.col(f"high_{m}"))
    kept = F.when(F.col("base_failed"), False).otherwise(F.coalesce(inside, F.lit(True)))
    return left.join(limits, same, "left").select(*rows.columns, kept.alias("kept"))
