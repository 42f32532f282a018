"""Filter interaction audit: what every order of five filters removes, by path counts on a lattice.

A state of the lattice is the set of filters that have been applied; an edge applies one more. What
an edge removes depends on its state alone, not on the order that led there, so rows are read once,
into a histogram of failures for each part, and 80 edges hold all that 120 orders ask for.

* ``forward[s]`` counts the orders that reach state ``s``, ``backward[s]`` those that lead from it to
  the full set; an edge lies on ``forward[s] * backward[s + f]`` orders. That weight times the rows it
  removes, summed over the edges of a filter, is the filter's Shapley sum over all orders.
* The step of an order is read from the edge it takes.

Filters fail a text (null: empty) as follows; words are runs of anything but ASCII white space.
A: under 50 words. B: 100 * distinct words < 65 * words. C: 100 * letters A-Z > 5 * code points.
D: holds one of ``#$%&*|``. E: identical to the text of a smaller ``doc_id`` anywhere in the table.

A to D are functions of the text, so E needs no group of equal texts in one place: rows are summed by
text and part before they meet, and only the least id of a text is apart. A digest stands for the text.

Odd input: a null ``source`` is the empty string. A row without ``doc_id`` never fails E and fails no
other. Rows that share an id and a text are both the first. A document counts as labelled 1 where any of
its labels is; without a label it is in no ``good_lost`` or ``toxic_lost``. Further columns make no
difference, also those whose names differ only in case. An empty table gives no rows; texts of any
length are read whole.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickrow.llm.common import exact

FILTERS = "ABCDE"
FULL = (1 << len(FILTERS)) - 1
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
_WORD = r"[^\x20\x09-\x0D]+"


def path_counts(n: int = len(FILTERS)) -> tuple[list[int], list[int]]:
    """For every subset of ``n`` filters: orders that reach it, and orders that lead on to the full set."""
    full = (1 << n) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    # A subset is a smaller number than all that contain it.
    for state in range(1, full + 1):
        forward[state] = sum(forward[state & ~(1 << f)] for f in range(n) if state >> f & 1)
    for state in reversed(range(full)):
        backward[state] = sum(backward[state | 1 << f] for f in range(n) if not state >> f & 1)
    return forward, backward


def edges(n: int = len(FILTERS)) -> list[tuple[int, int, int]]:
    """``(state, filter, orders through the edge)`` for every edge of the lattice."""
    forward, backward = path_counts(n)
    return [(s, f, forward[s] * backward[s | 1 << f]) for s in range(1 << n) for f in range(n) if not s >> f & 1]


def own_failures(text: Column) -> Column:
    """A to D as the bits 0 to 3."""
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    n_words = F.size(words).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    fails = [
        n_words < 50,
        100 * F.size(F.array_distinct(words)).cast("long") < 65 * n_words,
        100 * capitals > 5 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(fails)), F.lit(0))


def histogram(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: rows of every part by the set of filters that they fail."""
    text = F.coalesce("text", F.lit(""))
    rows = exact(docs, "doc_id", "text", "source").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("part"),
        F.sha2(text.cast("binary"), 256).alias("sha"),
        own_failures(text).alias("mask"),
    )
    marks = exact(labels, "doc_id", "quality", "toxic").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    marked = rows.join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    # One row for each id and text, which the join has already brought together.
    single = marked.groupBy("doc_id", "sha", "part", "mask").agg(
        F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    counts = ["n", "good", "toxic"]
    known = F.col("doc_id").isNotNull()
    by_text = single.groupBy("sha", "part", "mask").agg(
        *[F.sum(c).alias(c) for c in counts],
        *[F.coalesce(F.sum(F.when(~known, F.col(c))), F.lit(0)).alias(f"{c}_null") for c in counts],
        F.min(F.when(known, F.struct("doc_id", *counts))).alias("least"),
    )
    # A text has at most one row here for each part.
    first = F.col("least.doc_id") == F.min("least.doc_id").over(Window.partitionBy("sha"))
    spared = {c: F.when(first, F.col(f"least.{c}")).otherwise(0) + F.col(f"{c}_null") for c in counts}
    told = by_text.select("part", "mask", *counts, *[F.coalesce(x, F.lit(0)).alias(f"{c}_spared") for c, x in spared.items()])
    split = told.select(
        "part",
        F.inline(
            F.array(
                F.struct(F.col("mask"), *[F.col(f"{c}_spared").alias(c) for c in counts]),
                F.struct((F.col("mask") + 16).alias("mask"), *[(F.col(c) - F.col(f"{c}_spared")).alias(c) for c in counts]),
            )
        ),
    )
    return split.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in counts])


def lattice(counted: DataFrame) -> DataFrame:
    """``part, state, filter, orders`` and the measures of every edge; a part has all 80 of them."""
    listed = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(w).cast("long").alias("orders")) for s, f, w in edges()])
    rows = counted.select("*", F.inline(listed))
    bit = F.expr("shiftleft(1, filter)")
    fails, before = F.col("mask").bitwiseAND(bit) != 0, F.col("mask").bitwiseAND(F.col("state")) != 0
    total = lambda condition, c="n": F.sum(F.when(condition, F.col(c)).otherwise(0))
    return rows.groupBy("part", "state", "filter", "orders").agg(
        total(~fails & ~before).alias("kept"),
        total(fails & ~before).alias("removed"),
        total(fails & before).alias("redundant"),
        total(F.col("mask") == bit).alias("unique_fails"),
        total(fails & ~before, "good").alias("good_lost"),
        total(fails & ~before, "toxic").alias("toxic_lost"),
    )



def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step``, the measures of that step, and ``shapley`` of its filter."""
    spark = docs.sparkSession
    steps = [
        ("".join(FILTERS[f] for f in order), i + 1, sum(1 << g for g in order[:i]), f)
        for order in permutations(range(len(FILTERS)))
        for i, f in enumerate(order)
    ]
    # 600 rows, whatever the input.
    walked = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, state int, filter int"))
    edges_of = lattice(histogram(docs, labels))
    valued = edges_of.withColumn("shapley", F.sum(F.col("orders") * F.col("removed")).over(Window.partitionBy("part", "filter")))
    return valued.join(walked, ["state", "filter"]).select("part", "filter_order", "step", *MEASURES, "shapley")
