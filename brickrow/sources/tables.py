"""Readers and writers. Parquet inside, CSV for exchange."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from brickrow import lookups, schemas
from brickrow.operators import clean
from brickrow.sources import records, versions

log = logging.getLogger(__name__)

CSV_FORMAT = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A CSV file or directory with header, every column as text, missing-value texts as null.

    A file is split among tasks; ``multiline`` allows line breaks inside quotes, for which the files are
    read twice (``records``). A missing path raises.
    """
    table = records.read_records(spark, path, CSV_FORMAT) if multiline else spark.read.options(**CSV_FORMAT).csv(path)
    return table.select(
        *[F.when(~F.col(c).isin(lookups.CSV_NULLS), F.col(c)).alias(c) for c in table.columns]
    )


def read_urls_csv(spark: SparkSession, path: str) -> DataFrame:
    """A URL list with ``seq``, the place of every row: file, block, row."""
    table = spark.read.options(**CSV_FORMAT).csv(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return table.select("*", place.alias("seq"))


def read_staging_csv(spark: SparkSession, path: str) -> DataFrame:
    """A URL list for staging; a missing path is an empty list."""
    try:
        return read_urls_csv(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = "url string, seq struct<file:string,block:bigint,row:bigint>"
        return spark.createDataFrame([], empty)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages: ``page_id, url, html, status``. A null ``html`` or a status from 400 on is a failed
    fetch; the status is null where it was not kept."""
    return spark.read.schema(schemas.PAGES).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def counted(table: DataFrame) -> tuple[DataFrame, Observation]:
    """The table, and a count of its rows that is known once the table has been written."""
    rows = Observation()
    return table.observe(rows, F.count("*").alias("n_rows")), rows


def _saved(rows: Observation, path: str) -> str:
    log.info("%d rows saved to %s", rows.get.get("n_rows", 0), path)
    return path


def write_table(table: DataFrame, path: str) -> str:
    table, rows = counted(table)
    table.write.mode("overwrite").parquet(path)
    return _saved(rows, path)


def write_csv(table: DataFrame, path: str, multiline: bool = False) -> str:
    """Every row on one line: line breaks inside texts become spaces, unless ``multiline`` keeps them."""
    if not multiline:
        texts = {c for c, kind in table.dtypes if kind == "string"}
        table = table.select(*[F.translate(c, "\r\n", "  ").alias(c) if c in texts else c for c in table.columns])
    table, rows = counted(table)
    table.write.mode("overwrite").options(**CSV_FORMAT).csv(path)
    return _saved(rows, path)


def write_url_list(frontier: DataFrame, path: str, order: list[str]) -> str:
    """The URLs as one column ``link``, in order."""
    return write_csv(frontier.orderBy(*order).select(F.col("url").alias("link")), path)


def write_silver(silver: DataFrame, path: str, told: Observation, counts: list[Column]) -> str:
    """SILVER by province, as a new data folder under ``path`` that no reader sees yet; its name.

    The rebalance keeps files few and splits a province that is large. ``told`` learns the ``counts`` of
    the rows as they are written.
    """
    folder = versions.new_folder(path)
    balanced = silver.hint("rebalance", "province").observe(told, *counts)
    balanced.write.partitionBy("province").parquet(f"{path}/{folder}")
    return folder


def read_silver_folder(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SILVER).parquet(path).select(*schemas.SILVER.names)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The published SILVER."""
    folders = versions.current(spark, path)
    if not folders:
        raise FileNotFoundError(f"nothing is published in {path}")
    return read_silver_folder(spark, f"{path}/{folders['silver']}")


def write_silver_csv(silver: DataFrame, path: str) -> str:
    """SILVER as CSV, dearest first."""
    return write_csv(clean.dearest_first(silver), path)
