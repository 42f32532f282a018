"""Connected components of a graph that only executors hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickrow.llm.common import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of a link; the root is the least node of its component.

    Each round a node takes the least root among its own and its neighbours', then the root of that
    root. Rounds end when none changes; both steps are joins, and every round is written to the
    shared folder.
    """
    pairs = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = stored(pairs.unionByName(pairs.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges")
    roots = stored(both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "roots")
    while True:
        seen = roots.select(F.col("node").alias("other"), F.col("root").alias("near"))
        least = both.join(seen, "other").groupBy("node").agg(F.min("near").alias("near"))
        nearer = roots.join(least, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
        after = nearer.join(jump, "root", "left").select("node", F.least("root", "next").alias("root"), "was")
        now = stored(after, "roots")
        if now.where(F.col("root") != F.col("was")).isEmpty():
            return now.select("node", "root")
        roots = now.select("node", "root")
