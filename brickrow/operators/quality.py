"""Quality gate and table profile."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from brickrow import lookups

log = logging.getLogger(__name__)


class QualityGateError(ValueError):
    """The cleaned table must not be published."""


def gate_columns() -> list[Column]:
    """What the gate asks of a table: records, records without a price, records outside the postal ranges."""
    return [
        F.count("*").alias("n_rows"),
        F.count_if(F.col("price_eur").isNull()).alias("n_null_prices"),
        F.count_if(F.col("province") == lookups.PROVINCE_INVALID).alias("n_outside"),
    ]


def gate_counts(silver: DataFrame) -> DataFrame:
    """One row with :func:`gate_columns`."""
    return silver.agg(*gate_columns())


def observed(told: Observation) -> Row:
    """The counts of a table that was observed as it was written; of an empty one Spark may tell none."""
    counts = told.get
    return Row(**{name: counts.get(name, 0) for name in ("n_rows", "n_null_prices", "n_outside")})


def judge(counts: Row) -> Row:
    """Raise when the table is empty or a price is missing; warn about foreign postal codes."""
    if counts.n_rows < 1:
        raise QualityGateError("the cleaned table is empty")
    if counts.n_null_prices:
        raise QualityGateError(f"{counts.n_null_prices} records without a price")
    if counts.n_outside:
        log.warning("%d records outside the postal ranges", counts.n_outside)
    return counts


def check(silver: DataFrame) -> Row:
    """:func:`judge` of a table that is there."""
    return judge(gate_counts(silver).first())


def shape(table: DataFrame) -> tuple[int, int]:
    return table.count(), len(table.columns)


def profile(table: DataFrame) -> DataFrame:
    """Per column: position, name, type and number of values that are not null."""
    return _profile(table, table.agg(*_counts(table)))


def _counts(table: DataFrame) -> list[Column]:
    return [F.count(c).alias(c) for c in table.columns]


#: Parquet files by the reader that takes counts from their footers.
_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def footers(spark: SparkSession) -> Iterator[None]:
    """Inside, Parquet tables are read and counted by way of their footers."""
    before = {key: spark.conf.get(key) for key in _FOOTERS}
    try:
        for key, setting in _FOOTERS.items():
            spark.conf.set(key, setting)
        yield
    finally:
        for key, setting in before.items():
            spark.conf.set(key, setting)


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """Values of every column of a stored Parquet table; call it and what reads it inside :func:`footers`."""
    table = spark.read.parquet(path)
    return table.agg(F.count("*").alias("*"), *_counts(table))


def stored_profile(spark: SparkSession, path: str) -> DataFrame:
    """:func:`profile` of a stored Parquet table, from the footers of its files: no data page is read."""
    with footers(spark):
        counts = stored_counts(spark, path).drop("*").toArrow()  # one row
    return _profile(spark.read.parquet(path), spark.createDataFrame(counts))


def stored_shape(spark: SparkSession, path: str) -> tuple[int, int]:
    """Rows and columns of a stored Parquet table, from the footers of its files."""
    with footers(spark):
        counts = stored_counts(spark, path)
        return counts.first()["*"], len(counts.columns) - 1


def _profile(table: DataFrame, counts: DataFrame) -> DataFrame:
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("column_type"),
            F.col(name).alias("n_values"),
        )
        for i, (name, kind) in enumerate(table.dtypes)
    ]
    return counts.select(F.inline(F.array(*entries)))
