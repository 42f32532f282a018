"""Look-up of a number in a table of ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickrow import lookups


def range_lookup(table: DataFrame, ranges: DataFrame, value: str, width: int) -> DataFrame:
    """Left join on ``low <= value <= high`` with the other columns of ``ranges`` added.

    Each range is entered once per block of ``width`` it touches, which makes the look-up an
    equi-join on the block; Spark broadcasts a small range table and shuffles a large one.
    Ranges must not overlap. Rows without a value have blocks of their own, below all others, so that
    they do not meet in one task.
    """
    spread = -1 - F.pmod(F.xxhash64(*table.columns), F.lit(1000))
    block = F.when(F.col(value).isNull(), F.lit(-(2**40)) + spread).otherwise(F.floor(F.col(value) / width))
    blocks = F.sequence(F.floor(F.col("low") / width), F.floor(F.col("high") / width))
    entered = ranges.withColumn("_block", F.explode(blocks))
    hit = (block == F.col("_block")) & F.col(value).between(F.col("low"), F.col("high"))
    return table.join(entered, hit, "left").drop("_block", "low", "high")


def province_ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(lookups.PROVINCE_RANGES, "low int, high int, province string")


def province_by_join(table: DataFrame, postal: str = "postal_code") -> DataFrame:
    """Same result as :func:`brickrow.functions.places.province`, from a table of ranges."""
    numbered = table.withColumn("_zip", F.trim(postal).try_cast("int"))
    ranges = F.broadcast(province_ranges(table.sparkSession))  # a fixed table of 13 rows
    found = range_lookup(numbered, ranges, "_zip", 100)
    named = F.when(F.col("_zip").isNull(), lookups.PROVINCE_UNKNOWN).otherwise(
        F.coalesce("province", F.lit(lookups.PROVINCE_INVALID))
    )
    return found.withColumn("province", named).drop("_zip")
