"""What the plans must and must not contain."""

import contextlib
import io

import pytest

from brickrow.operators import clean, frontier, listing, quality
from brickrow.plans import stages
from brickrow.proof import render
from brickrow.proof.queries import QUERIES
from brickrow.sources import buckets, tables

SF = "/root/testdata/sf0.001"


def plan(table):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        table.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def pages(spark):
    return tables.read_pages(spark, f"{SF}/pages.parquet")


@pytest.mark.parametrize("name", [n for n in QUERIES if "stream" not in n and "roundtrip" not in n])
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_pages_are_parsed_where_they_are_read(pages):
    text = plan(listing.records(pages))
    assert "Exchange" not in text
    assert text.count("MapInArrow") == 2  # once in the tree, once in the details


def test_only_read_columns_reach_the_parser(pages):
    text = plan(frontier.collect_urls(pages, "https://site.example"))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in text


def test_html_is_not_shuffled(spark, pages):
    urls = pages.select("url").distinct()
    text = plan(listing.scrape(urls, pages))
    exchanges = [part for part in text.split("\n\n") if part.lstrip().startswith("(") and ") Exchange" in part]
    assert exchanges and not any("html" in part or "nodes" in part or "segs" in part for part in exchanges)
    assert "StringContains(url,/en/detail/)" in text


def test_only_the_pages_that_are_asked_for_are_parsed(pages):
    """The join with the frontier lies below the parser."""
    text = plan(listing.scrape_new(pages.select("url").distinct(), pages))
    tree = text.split("\n\n")[0].split("\n")
    parser = next(i for i, line in enumerate(tree) if "MapInArrow" in line)
    assert any("Join LeftSemi" in line for line in tree[parser:])


@pytest.fixture
def no_broadcast(spark):
    """The tables of the tests are small; large ones are not broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_bucketed_pages_and_raw_are_not_exchanged(spark, tmp_path, no_broadcast):
    pages = render.listing_pages(spark.read.parquet(f"{SF}/orders.parquet"))
    stored = buckets.write(pages, "pages_of_a_test", "url", 8, str(tmp_path / "pages"))
    read = listing.to_raw(listing.records(stored.where("page_id % 2 = 0")))
    raw = buckets.write(read, "raw_of_a_test", "property_url", 8, str(tmp_path / "raw"))
    urls = stored.select("url").where("page_id % 3 = 0")
    text = plan(frontier.not_yet_scraped(urls, raw))
    assert "Exchange" not in text and "Join LeftAnti" in text
    new = stages.scrape_new(urls, raw, stored)
    text = plan(new)
    exchanges = [part for part in text.split("\n\n") if part.lstrip().startswith("(") and ") Exchange" in part]
    # Only records that were read from pages move, by their URL.
    assert exchanges and all("property_code" in part and "html" not in part for part in exchanges)
    assert new.count() == urls.count() - raw.join(urls, raw.property_url == urls.url).count()
    for name in ("pages_of_a_test", "raw_of_a_test"):
        spark.sql(f"DROP TABLE {name}")


def test_counts_of_a_stored_table_come_from_footers(spark, tmp_path):
    rows = [("a", 1, None), (None, 2, 2.0), ("c", None, None)]
    path = tables.write_table(spark.createDataFrame(rows, "a string, b bigint, c double"), str(tmp_path / "t"))
    with quality.footers(spark):
        text = plan(quality.stored_counts(spark, path))
    assert "PushedAggregation: [COUNT(*), COUNT(a), COUNT(b), COUNT(c)]" in text
    assert quality.stored_profile(spark, path).collect() == quality.profile(tables.read_table(spark, path)).collect()
    assert quality.stored_shape(spark, path) == (3, 3)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


PAGE_QUERIES = ["link_extract", "link_normalize", "page_class_text", "page_heading", "page_text", "page_outcomes", "collapse_text"]


@pytest.mark.parametrize("name", PAGE_QUERIES)
def test_registered_queries_do_not_shuffle_pages_or_texts(spark, name):
    text = plan(QUERIES[name](spark, SF))
    exchanges = [part for part in text.split("\n\n") if part.lstrip().startswith("(") and ") Exchange" in part]
    wide = ("html", "nodes", "segs", " text#", "[text#")
    assert not any(word in part for part in exchanges for word in wide)


def test_elements_are_chosen_in_the_parser(pages):
    """One parse, and no array of all elements after it."""
    for table in (listing.labelled_values(pages), listing.records(pages), clean.silver(listing.to_raw(listing.records(pages)))):
        text = plan(table)
        assert text.count("MapInArrow") == 2  # once in the tree, once in the details
        assert "nodes" not in text and "segs" not in text
    # The pairs of a page are built once, also where a filter or the size of an array asks for them.
    assert plan(listing.labelled_values(pages)).count("near AS value") <= 1


@pytest.mark.parametrize("name", ["h4_pairs", "raw_records", "silver", "card_links", "collect_urls", "scrape_new"])
def test_rendered_inputs_are_dealt_out_by_a_fixed_number(spark, name):
    """A number of partitions that adaptive execution keeps."""
    assert "REPARTITION_BY_NUM" in plan(QUERIES[name](spark, SF))


def test_price_filter_reaches_the_scan(spark, tmp_path, monkeypatch):
    raw = listing.to_raw(spark.createDataFrame([("u", 20000)], "property_url string, price_eur bigint"))
    stored = tables.read_table(spark, tables.write_table(raw, str(tmp_path / "raw")))
    seen = []
    monkeypatch.setattr(stages, "publish", lambda silver, path, csv_path: seen.append(silver))
    stages.refine(stored, "unused")
    text = plan(seen[0])
    assert "GreaterThanOrEqual(price_eur,10000)" in text
    assert "heating_type" not in text.split("ReadSchema")[1].split("\n")[0]
    assert text.count("ArrowEvalPython") == 2  # once in the tree, once in the details


def test_the_best_record_is_chosen_before_the_shuffle(spark):
    table = spark.createDataFrame([("A", "u", 1)], "property_code string, property_url string, price_eur bigint")
    assert plan(clean.best_per_code(table)).count("Partial") >= 1
    assert "WindowGroupLimit" in plan(clean.best_per_url(table))
