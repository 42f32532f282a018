"""First row per key, with the order stated in columns.

Both operators reduce every task's rows to one per key before the shuffle (partial aggregation, or
the partial group limit Spark plans under ``row_number() == 1``), so a hot key costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_seen(urls: DataFrame, seq: str = "seq", url: str = "url") -> DataFrame:
    """Distinct URLs with the smallest ``seq`` as ``first_seen``."""
    return urls.groupBy(url).agg(F.min(seq).alias("first_seen"))


def first_row(table: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of every key with all its columns; null keys count as one key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return table.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")
