"""Seconds per headline query, as one line of JSON.

Each query runs to the end into a sink that discards rows. ``BENCH_SF_DIR`` names the tables,
``BENCH_CPUS`` the cores, ``BENCH_RUNS`` how often each query runs (its median counts). Besides the
registered queries, some steps are timed from stored inputs, without the rendering of the test input.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from pyspark.sql import DataFrame, SparkSession

from brickrow.operators import clean, listing
from brickrow.proof import render
from brickrow.proof.queries import QUERIES
from brickrow.sources import tables
from brickrow.sources.scratch import scratch_dir

HEADLINE = [
    "listings_by_province",
    "silver",
    "silver_from_pages",
    "raw_records",
    "scrape_new",
    "h4_pairs",
    "page_text",
    "link_extract",
    "link_normalize",
    "collect_urls",
    "card_links_fallback",
    "url_stage",
    "load_urls",
    "staging_counts",
    "incremental_frontier",
    "collapse_text",
    "parse_price",
    "null_tokens",
    "province_join",
    "quality_gate",
    "profile",
    "csv_roundtrip",
    "io_roundtrip",
    "url_list_roundtrip",
    "stream_available_now",
    "stream_best",
]


def make_session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    return timed(lambda: QUERIES[name](spark, sf_dir))


def from_stored(spark: SparkSession, sf_dir: str) -> dict:
    """Steps over inputs that are rendered and written before the clock starts."""

    def stored(table: DataFrame, name: str) -> DataFrame:
        return tables.read_table(spark, tables.write_table(table, scratch_dir(spark, name)))

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
    orders = orders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    raw, pages = stored(render.dirty_raw(orders), "raw"), stored(render.listing_pages(orders), "pages")
    few = stored(pages.where("page_id % 100 = 0").select("url"), "urls")
    return {
        "silver_stored_raw": lambda: clean.silver(raw),
        "records_stored_pages": lambda: listing.records(pages),
        "scrape_new_1_percent": lambda: listing.scrape_new(few, pages),
        "scrape_1_percent": lambda: listing.scrape(few, pages),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = make_session(int(os.environ.get("BENCH_CPUS", "8")))
    names = sys.argv[1:] or HEADLINE
    # Start the JVM paths and the Python workers before the clock does.
    run(spark, "silver_from_pages", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    steps = {name: lambda name=name: QUERIES[name](spark, sf_dir) for name in names}
    if not sys.argv[1:]:
        steps |= from_stored(spark, sf_dir)
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    seconds = {name: round(median(timed(make) for _ in range(runs)), 3) for name, make in steps.items()}
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
