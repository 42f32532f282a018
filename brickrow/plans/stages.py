"""The three stages, each from table to table."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from brickrow import lookups
from brickrow.operators import clean, frontier, listing, quality
from brickrow.operators.distinct import first_row
from brickrow.sources import buckets as bucket_tables
from brickrow.sources import files, tables, versions

log = logging.getLogger(__name__)


def collect(result_pages: DataFrame, base_url: str, path: str) -> str:
    """Result pages to the ordered list of distinct detail URLs."""
    urls = frontier.collect_urls(result_pages, base_url)
    return tables.write_url_list(urls, path, ["first_page", "first_pos"])


def stage(spark: SparkSession, source: str, path: str) -> Row | None:
    """Sale and project pages of a URL list, each once and in order, to a new list.

    Returns the counts; a missing or empty list is left alone and gives none.
    """
    table = tables.read_staging_csv(spark, source)
    counts = frontier.staging_counts(table).first()
    if not counts.n_before:
        log.warning("no URLs to stage in %s", source)
        return None
    tables.write_csv(frontier.stage_urls(table).orderBy("seq").drop("seq"), path)
    return counts


def stage_all(spark: SparkSession, source: str, path: str) -> tuple[int, int]:
    """All distinct rows of a URL list to a new list; rows before and after. Must exist.

    Both are counted while the list is written.
    """
    table, before = tables.counted(tables.read_csv(spark, source))
    distinct, after = tables.counted(frontier.stage_distinct(table))
    tables.write_csv(distinct, path)
    return before.get["n_rows"], after.get["n_rows"]


def raw_records(url_table: DataFrame, pages: DataFrame, limit: int | None = None) -> DataFrame:
    """URL list and pages to RAW, one row per URL in the list.

    ``limit`` cuts the list before and after its filter, as a trial run does.
    """
    urls = frontier.take_first(frontier.load_urls(url_table, limit), limit)
    # The frontier is already unique per URL, so the records are too.
    return listing.to_raw(listing.scrape(urls, pages))


def scrape(url_table: DataFrame, pages: DataFrame, path: str, limit: int | None = None) -> str:
    return tables.write_table(raw_records(url_table, pages, limit), path)


def scrape_new(frontier_table: DataFrame, raw: DataFrame | None, pages: DataFrame) -> DataFrame:
    """RAW records of the frontier URLs that RAW has not read yet, failed ones included."""
    urls = frontier_table if raw is None else frontier.not_yet_scraped(frontier_table, raw)
    return listing.to_raw(listing.scrape_new(urls, pages))


def append_new(
    frontier_table: DataFrame, pages: DataFrame, name: str, buckets: int | None = None, path: str | None = None
) -> int:
    """From a frontier to the RAW table ``name``, a run at a time: what is new or failed before is scraped.

    The table is bucketed by URL. A run appends its own records and rewrites none; a URL that failed before
    then has two, of which the later run's counts. ``buckets`` must stay the same over runs; it is the
    session's number of shuffle partitions unless given. Returns the number of the run.
    """
    spark = pages.sparkSession
    rows = scrape_new(frontier_table, current_raw(spark, name), pages)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return bucket_tables.append_run(rows, name, "property_url", n, path)


def current_raw(spark: SparkSession, name: str) -> DataFrame | None:
    """RAW as ``append_new`` left it, or none: the last record of every URL, found inside each bucket."""
    if not spark.catalog.tableExists(name):
        return None
    return first_row(spark.table(name), ["property_url"], [F.desc(bucket_tables.RUN)]).drop(bucket_tables.RUN)


def publish(silver: DataFrame, path: str, csv_path: str | None = None) -> Row:
    """Write SILVER and make it the published version if it passes the gate; the gate's counts.

    It is written once, to a folder beside the published one, and what the gate asks for is counted as it is
    written. A table that fails, or a run that breaks off, leaves the published version as it was. With
    ``csv_path`` the published version is also written as CSV, dearest first. Should Spark repeat tasks
    that were done, counts may be too high; whether they are zero, which the gate asks, they still tell.
    """
    spark = silver.sparkSession
    told = Observation()
    folder = tables.write_silver(silver, path, told, quality.gate_columns())
    counts = quality.observed(told)
    try:
        quality.judge(counts)
    except quality.QualityGateError:
        files.remove(spark, f"{path}/{folder}")
        raise
    versions.switch(spark, path, {"silver": folder})
    if csv_path:
        tables.write_silver_csv(tables.read_silver_folder(spark, f"{path}/{folder}"), csv_path)
    return counts


def refine(
    raw: DataFrame,
    path: str,
    keep_null_codes: bool = False,
    max_build_year: int = lookups.MAX_BUILD_YEAR,
    csv_path: str | None = None,
) -> Row:
    """A stored RAW table to a published SILVER."""
    if dict(raw.dtypes)["price_eur"] != "string":
        raw = clean.filter_prices(raw)  # on typed prices the scan itself can skip rows
    return publish(clean.silver(raw, keep_null_codes, max_build_year), path, csv_path)


def province_summary(silver: DataFrame) -> DataFrame:
    return silver.groupBy("province").agg(
        F.count("*").alias("n_listings"), F.avg("price_eur").alias("avg_price")
    )
