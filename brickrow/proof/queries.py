"""Every operator as a query on the test tables. Column names match :mod:`brickrow.proof.oracles`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickrow import lookups, schemas
from brickrow.functions import links, places, text
from brickrow.operators import clean, frontier, html, listing, quality, ragged, ranges
from brickrow.plans import stages
from brickrow.proof import render, texts
from brickrow.sources import buckets, tables
from brickrow.sources.scratch import scratch_dir
from brickrow.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


def _spread_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three narrow columns, dealt out so that rendering them uses all tasks."""
    return _dealt(_orders(spark, sf_dir))


def _dealt(orders: DataFrame) -> DataFrame:
    # With the number given, adaptive execution does not put the small rows back into one partition.
    return orders.repartition(int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_pages(spark, f"{sf_dir}/pages.parquet")


def _listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.listing_pages(_spread_orders(spark, sf_dir))


def _dirty_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.dirty_raw(_spread_orders(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.silver(_dirty_raw(spark, sf_dir))


# --- cleaning --------------------------------------------------------------------------------


def listings_by_province(spark, sf_dir):
    return stages.province_summary(_silver(spark, sf_dir))


def silver_no_code_kept(spark, sf_dir):
    return clean.silver(_dirty_raw(spark, sf_dir), keep_null_codes=True)


def silver_without_postal(spark, sf_dir):
    """RAW without the postal column: every province is unknown."""
    return clean.silver(_dirty_raw(spark, sf_dir).drop("postal_code"))


def silver_from_pages(spark, sf_dir):
    return clean.silver(listing.to_raw(listing.records(_listing_pages(spark, sf_dir))))


def clean_rows(spark, sf_dir):
    rows = clean.clean_rows(_dirty_raw(spark, sf_dir))
    return rows.groupBy("province").agg(
        F.count("*").alias("n_rows"),
        F.count("build_year").alias("n_years"),
        F.count("property_type").alias("n_types"),
        F.count("state_of_the_property").alias("n_states"),
        F.sum("price_eur").alias("sum_price"),
    )


def top_head(spark, sf_dir):
    return clean.head(_silver(spark, sf_dir)).select("property_url", "property_code", "price_eur", "province")


def quality_gate(spark, sf_dir):
    return quality.gate_counts(_silver(spark, sf_dir))


def _stored_silver(spark, sf_dir):
    """SILVER written once, for queries that read it several times."""
    return tables.read_table(spark, tables.write_table(_silver(spark, sf_dir), scratch_dir(spark, "silver")))


def gate_outcomes(spark, sf_dir):
    """What the gate says of a good table, an empty one, and one that lacks prices."""
    good = _stored_silver(spark, sf_dir)
    without = good.withColumn("price_eur", F.when(F.col("bedrooms") != 3, F.col("price_eur")))
    rows = []
    for name, table in {"good": good, "empty": good.where("bedrooms < -1"), "no price": without}.items():
        try:
            rows.append((name, f"{quality.check(table).n_rows} records pass"))
        except quality.QualityGateError as error:
            rows.append((name, str(error)))
    return spark.createDataFrame(rows, "table_name string, outcome string")


def table_shape(spark, sf_dir):
    """Rows and columns of SILVER, and the rows that were counted as it was saved."""
    path = scratch_dir(spark, "counted")
    table, saved = tables.counted(_silver(spark, sf_dir))
    table.write.parquet(path)
    n_rows, n_columns = quality.shape(tables.read_table(spark, path))
    return spark.createDataFrame([(n_rows, n_columns, saved.get["n_rows"])], "n_rows bigint, n_columns bigint, n_saved bigint")


def profile(spark, sf_dir):
    return quality.profile(_silver(spark, sf_dir))


def stored_profile(spark, sf_dir):
    """The profile of SILVER as it is stored, from the footers of its files."""
    return quality.stored_profile(spark, tables.write_table(_silver(spark, sf_dir), scratch_dir(spark, "profiled")))


# --- frontier and links ----------------------------------------------------------------------

def frontier_urls(spark, sf_dir):
    """As many search pages per province as its listings fill."""
    located = render.keyed(_orders(spark, sf_dir)).select(places.province(render.postal()).alias("name"))
    slug = places.literal_map(lookups.SLUG_OF)[F.col("name")]
    counted = located.groupBy(slug.alias("province")).agg(F.ceil(F.count("*") / render.CARDS_PER_PAGE).alias("n_pages"))
    slugs = F.array(*map(F.lit, lookups.PROVINCE_SLUGS))
    numbered = counted.where("province IS NOT NULL").withColumn("province_no", F.array_position(slugs, F.col("province")) - 1)
    return frontier.search_pages(numbered, render.SITE)


def link_extract(spark, sf_dir):
    return frontier.anchor_links(_pages(spark, sf_dir)).select("page_id", "pos", "href")


def link_normalize(spark, sf_dir):
    """Every link of the pages in eight spellings."""
    found = frontier.anchor_links(_pages(spark, sf_dir))
    href = F.col("href")
    spellings = [
        href,
        F.substr(href, F.lit(2)),
        F.concat(F.lit("//cdn.example.net"), href),
        F.concat(F.lit("?page="), F.col("pos").cast("string")),
        F.concat(F.lit("/en/./x/.."), href),
        F.concat(F.lit(" ../a/../en/detail"), href),
        F.concat(F.lit("HTTP://Other.example.net"), href),
        F.lit("mailto:a@b"),
    ]
    spelled = found.select("page_id", "pos", F.posexplode(F.array(*spellings)).alias("kind", "href"))
    return frontier.normalize_links(spelled, render.SITE).select("page_id", "pos", "kind", "url")


def detail_links(spark, sf_dir):
    found = frontier.anchor_links(_pages(spark, sf_dir))
    part = F.when(F.col("pos") % 2 == 0, "/en/detail").otherwise("/en/projectdetail")
    urls = frontier.normalize_links(found.withColumn("href", F.concat(part, "href")), render.SITE)
    first = urls.groupBy("url").agg(F.min("page_id").alias("first_seen"))
    return frontier.keep_details(first)


def card_links(spark, sf_dir):
    pages = render.result_pages(_spread_orders(spark, sf_dir))
    return frontier.card_links(pages).select("page_id", "pos", "href")


def card_links_fallback(spark, sf_dir):
    pages = render.result_pages(_spread_orders(spark, sf_dir))
    return frontier.card_links_or_anchors(pages, render.SITE).select("page_id", "pos", "href")


def collect_urls(spark, sf_dir):
    return frontier.collect_urls(render.result_pages(_spread_orders(spark, sf_dir)), render.SITE)


def _url_table(spark, sf_dir):
    """Page URLs in four spellings, two of them the same."""
    url = F.col("url")
    sale = F.replace(url, F.lit("/en/"), F.lit("/en/detail/Sale/"))
    project = F.replace(url, F.lit("/en/"), F.lit("/en/projectDetail/"))
    listed = tables.read_pages(spark, f"{sf_dir}/pages.parquet").select("page_id", "url")
    spelled = listed.select("page_id", F.posexplode(F.array(url, sale, project, sale)).alias("kind", "url"))
    return spelled.select((F.col("page_id") * 4 + F.col("kind")).alias("seq"), "url", "kind")


def url_stage(spark, sf_dir):
    return frontier.stage_urls(_url_table(spark, sf_dir))


def url_stage_distinct(spark, sf_dir):
    return frontier.stage_distinct(_url_table(spark, sf_dir).select("url"))


def staging_counts(spark, sf_dir):
    return frontier.staging_counts(_url_table(spark, sf_dir))


def staged_files(spark, sf_dir):
    """Staging from file to file: counts, the list that was written, and a missing source."""
    source, path, every, none = (scratch_dir(spark, n) for n in ("source", "staged", "every", "none"))
    tables.write_csv(_url_table(spark, sf_dir).orderBy("seq").select("url", "kind"), source)
    counts = stages.stage(spark, source, path)
    before, after = stages.stage_all(spark, source, every)
    missing = 0 if stages.stage(spark, none, scratch_dir(spark, "unused")) is None else 1
    try:
        stages.stage_all(spark, none, scratch_dir(spark, "unused"))
        raises = 0
    except AnalysisException:
        raises = 1
    rows = [*counts.asDict().items(), ("all_before", before), ("all_after", after), ("missing", missing), ("missing_raises", raises)]
    listed = tables.read_csv(spark, path).select("url", F.col("kind").cast("bigint").alias("n"))
    return spark.createDataFrame(rows, "url string, n bigint").unionByName(listed)


def load_urls(spark, sf_dir):
    spaced = _url_table(spark, sf_dir).withColumn("link", F.concat(F.lit(render.HARD), "url", F.lit(" ")))
    return frontier.load_urls(spaced.select("link", "seq"))


def url_limit(spark, sf_dir):
    loaded = frontier.load_urls(_url_table(spark, sf_dir).select("url", "seq"), limit=120)
    return frontier.take_first(loaded, 10)


def incremental_frontier(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    urls = render.keyed(orders).select(render.listing_url().alias("url"))
    filled = render.keyed(orders.where("o_orderstatus = 'F'"))
    return frontier.not_yet_scraped(urls, filled.select(render.listing_url().alias("property_url")))


# --- HTML and records ------------------------------------------------------------------------


def page_class_text(spark, sf_dir):
    parsed = html.parse_pages(_pages(spark, sf_dir), html.TEXT_FIELDS)
    node = html.first(F.filter("nodes", lambda n: html.has_class(n, "ad")))
    return parsed.select("page_id", html.node_text(node, F.col("segs")).alias("ad_text"))


def page_heading(spark, sf_dir):
    parsed = html.parse_pages(_pages(spark, sf_dir), html.TEXT_FIELDS)
    node = html.first(F.filter("nodes", lambda n: n.tag == "h1"))
    return parsed.select("page_id", html.node_text(node, F.col("segs")).alias("heading"))


def page_text(spark, sf_dir):
    parsed = html.parse_pages(_pages(spark, sf_dir), html.TEXT_FIELDS)
    whole = html.node_text(html.first(F.col("nodes")), F.col("segs"))
    return parsed.select("page_id", F.md5(whole).alias("text_md5"), F.char_length(whole).alias("n_chars"))


def page_outcomes(spark, sf_dir):
    """The pages' own URLs can be read but for one in ten with an error status; the URLs they link to cannot."""
    pages = _pages(spark, sf_dir)
    failed = F.when(F.col("page_id") % 10 == 0, 404).when(F.col("page_id") % 10 == 1, 200)
    detailed = pages.withColumn("url", F.concat(F.col("url"), F.lit("/en/detail/"))).withColumn("status", failed)
    linked = frontier.normalize_links(frontier.anchor_links(pages), render.SITE)
    linked = linked.select(F.replace("url", F.lit(render.SITE), F.lit(render.SITE + "/en/detail")).alias("url"))
    urls = detailed.select("url").unionByName(linked).distinct()
    return listing.outcomes(listing.scrape(urls, detailed))


def h4_pairs(spark, sf_dir):
    return listing.labelled_values(_listing_pages(spark, sf_dir)).select("page_id", "field", "value")


def cadastral_fallback(spark, sf_dir):
    return listing.records(_listing_pages(spark, sf_dir)).select("page_id", "cadastral_income_eur")


def raw_records(spark, sf_dir):
    """Every listing URL and one more that has no page; every page also in an older, empty version."""
    pages = _listing_pages(spark, sf_dir)
    older = pages.select((-1 - F.col("page_id")).alias("page_id"), "url", F.lit("<p>soon</p>").alias("html"))
    links_of = F.array("url", F.concat("url", F.lit("/gone")))
    urls = pages.select(F.col("page_id").alias("seq"), F.explode(links_of).alias("link"))
    return stages.raw_records(urls, pages.unionByName(older))


def _filled(spark, sf_dir):
    """RAW as an earlier run left it: the filled orders were read, the pending ones failed."""
    orders = _dealt(_table(spark, sf_dir, "orders"))
    read = listing.to_raw(listing.records(render.listing_pages(orders.where("o_orderstatus = 'F'"))))
    failed = render.keyed(orders.where("o_orderstatus = 'P'")).select(render.listing_url().alias("property_url"))
    stored = tables.write_table(listing.stack_ragged([read, failed]), scratch_dir(spark, "raw"))
    return orders, tables.read_table(spark, stored)


def scrape_new(spark, sf_dir):
    """Only what is not read yet, failed pages again; every page also in an older, empty version."""
    orders, raw = _filled(spark, sf_dir)
    pages = render.listing_pages(orders)
    older = pages.select((-1 - F.col("page_id")).alias("page_id"), "url", F.lit("<p>soon</p>").alias("html"))
    return stages.scrape_new(pages.select("url"), raw, pages.unionByName(older))


def _bucket_place(spark, name):
    """A name for a table of this run alone, and where its files lie."""
    path = scratch_dir(spark, name)
    return f"{name}_{path.split('-')[-1].split('/')[0]}", path


def scrape_new_bucketed(spark, sf_dir):
    """As ``scrape_new``, from pages and RAW in buckets by URL."""
    orders, raw = _filled(spark, sf_dir)
    pages = render.listing_pages(orders)
    older = pages.select((-1 - F.col("page_id")).alias("page_id"), "url", F.lit("<p>soon</p>").alias("html"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (pages_name, pages_path), (raw_name, raw_path) = _bucket_place(spark, "pages_by_url"), _bucket_place(spark, "raw_by_url")
    stored = buckets.write(pages.unionByName(older), pages_name, "url", n, pages_path)
    known = buckets.write(raw, raw_name, "property_url", n, raw_path)
    return stages.scrape_new(stored.select("url").where("page_id >= 0"), known, stored)


def append_new(spark, sf_dir):
    """Two runs into one RAW: half of the listings first, then all; pages that failed at first are read."""
    name, path = _bucket_place(spark, "raw_runs")
    pages = _listing_pages(spark, sf_dir)
    half = pages.where("page_id % 2 = 0")
    failed = half.where("page_id % 3 = 0").withColumn("html", F.lit(None).cast("string"))
    failing = half.where("page_id % 3 > 0").unionByName(failed)
    stages.append_new(half.select("url"), failing, name, path=path)
    stages.append_new(pages.select("url"), pages, name, path=path)
    return stages.current_raw(spark, name)


def raw_distinct(spark, sf_dir):
    """Ragged record sets stacked; the first record per URL kept."""
    rows = render.keyed(_orders(spark, sf_dir)).withColumn("property_url", render.listing_url())
    full = rows.select("property_url", F.col("k").alias("seq"), F.floor("total").cast("string").alias("price_eur"), F.lit(1).alias("extra"))
    failed = rows.select("property_url", (F.col("k") + F.when(F.col("k") % 2 == 0, -1).otherwise(1)).alias("seq"))
    stacked = listing.stack_ragged([full, failed])
    return listing.raw_table(stacked, [F.asc("seq")]).select("property_url", "price_eur", "garden_m2")


def ragged_records(spark, sf_dir):
    """Records as JSON: keys missing, too many, of another type than most have, and texts that are no JSON."""
    rows = render.json_records(_spread_orders(spark, sf_dir))
    return ragged.to_raw(ragged.as_variant(rows, "record"), "record").select("property_url", "price_eur", "bedrooms", "heating_type", "garden_m2")


# --- scalar functions ------------------------------------------------------------------------


def _scalar(source: Callable, **results: Callable) -> Query:
    def query(spark, sf_dir):
        rows = texts.texts(_orders(spark, sf_dir), v=source())
        return rows.select("k", *[fn(F.col("v")).alias(name) for name, fn in results.items()])

    return query


def collapse_text(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    prose = documents.select("doc_id", text.collapse(F.col("text")).alias("t"))
    return prose.select("doc_id", F.md5("t").alias("text_md5"), F.char_length("t").alias("n_chars"))


def null_tokens(spark, sf_dir):
    return clean.null_words(texts.texts(_orders(spark, sf_dir), v=texts.untidy()), ["v"])


def yes_no_strict(spark, sf_dir):
    rows = clean.null_words(texts.texts(_orders(spark, sf_dir), v=texts.untidy_flag()), ["v"])
    return rows.select("k", text.yes_no_strict(F.col("v")).alias("flag"))


def _postals(spark, sf_dir):
    return texts.texts(_orders(spark, sf_dir), v=F.when(F.col("k") % 29 == 0, None).otherwise(render.postal()))


def province_case(spark, sf_dir):
    return _postals(spark, sf_dir).select("k", places.province(F.col("v")).alias("province"))


def province_join(spark, sf_dir):
    return ranges.province_by_join(_postals(spark, sf_dir), "v").select("k", "province")


# --- sources, sinks, streams -----------------------------------------------------------------


def io_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "published")
    stages.publish(_silver(spark, sf_dir), path)
    return tables.read_silver(spark, path)


def csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "raw-csv")
    tables.write_csv(listing.to_raw(listing.records(_listing_pages(spark, sf_dir))), path)
    return listing.to_raw(tables.read_csv(spark, path))


def silver_csv(spark, sf_dir):
    """Published twice, the second time with the CSV beside it, which is read back."""
    path, csv_path = scratch_dir(spark, "published"), scratch_dir(spark, "silver-csv")
    silver = _stored_silver(spark, sf_dir)
    stages.publish(silver.limit(0).unionByName(silver.where("price_eur > 100000")), path)
    stages.publish(silver, path, csv_path)
    read = tables.read_csv(spark, csv_path)
    return read.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SILVER])


def url_list_roundtrip(spark, sf_dir):
    path = stages.collect(
        render.result_pages(_spread_orders(spark, sf_dir)), render.SITE, scratch_dir(spark, "urls")
    )
    return frontier.load_urls(tables.read_urls_csv(spark, path)).select("url")


def _runs(spark, sf_dir, silver):
    """Pages landed in several runs, some URLs again later; the folder of the kept records."""
    landing, path = scratch_dir(spark, "landing"), scratch_dir(spark, "stream-kept")
    orders = _spread_orders(spark, sf_dir)
    first = render.listing_pages(orders).withColumn("status", F.lit(None).cast("int"))
    for pages in (first, render.recrawled_pages(orders)):
        pages.write.mode("append").parquet(landing)
        incremental.stream_records(incremental.landed_pages(spark, landing), path).awaitTermination()
        if silver:
            incremental.stream_silver(spark, path)
    return path


def stream_available_now(spark, sf_dir):
    return incremental.current_raw(spark, _runs(spark, sf_dir, silver=False))


def stream_best(spark, sf_dir):
    return incremental.current_silver(spark, _runs(spark, sf_dir, silver=True))


QUERIES: dict[str, Query] = {
    "listings_by_province": listings_by_province,
    "silver": _silver,
    "silver_no_code_kept": silver_no_code_kept,
    "silver_without_postal": silver_without_postal,
    "silver_from_pages": silver_from_pages,
    "clean_rows": clean_rows,
    "top_head": top_head,
    "quality_gate": quality_gate,
    "gate_outcomes": gate_outcomes,
    "table_shape": table_shape,
    "profile": profile,
    "stored_profile": stored_profile,
    "frontier_urls": frontier_urls,
    "link_extract": link_extract,
    "link_normalize": link_normalize,
    "detail_links": detail_links,
    "card_links": card_links,
    "card_links_fallback": card_links_fallback,
    "collect_urls": collect_urls,
    "url_stage": url_stage,
    "url_stage_distinct": url_stage_distinct,
    "staging_counts": staging_counts,
    "staged_files": staged_files,
    "load_urls": load_urls,
    "url_limit": url_limit,
    "incremental_frontier": incremental_frontier,
    "page_class_text": page_class_text,
    "page_heading": page_heading,
    "page_text": page_text,
    "page_outcomes": page_outcomes,
    "h4_pairs": h4_pairs,
    "cadastral_fallback": cadastral_fallback,
    "raw_records": raw_records,
    "scrape_new": scrape_new,
    "scrape_new_bucketed": scrape_new_bucketed,
    "append_new": append_new,
    "raw_distinct": raw_distinct,
    "ragged_records": ragged_records,
    "collapse_text": collapse_text,
    "parse_price": _scalar(texts.price, price_eur=text.price_eur),
    "parse_area": _scalar(texts.area, area_m2=text.area_m2),
    "parse_epc": _scalar(texts.energy, energy_kwh=text.energy_kwh),
    "parse_int": _scalar(texts.number, first_int=text.first_int),
    "yes_no_lenient": _scalar(texts.answer, flag=text.yes_no_lenient),
    "split_locality": _scalar(texts.place, postal_code=text.locality_postal, locality_name=text.locality_name),
    "looks_locality": _scalar(texts.place, is_locality=text.looks_like_locality),
    "norm_label": _scalar(texts.label, label=text.norm_label),
    "label_field": _scalar(texts.label, field=places.field_of_label),
    "type_from_url": _scalar(texts.listing_link, property_type=places.type_from_url),
    "null_tokens": null_tokens,
    "to_numeric": _scalar(texts.untidy_number, number=text.to_number),
    "yes_no_strict": yes_no_strict,
    "postal_extract": _scalar(texts.untidy_postal, postal_code=text.postal_digits),
    "province_case": province_case,
    "province_join": province_join,
    "type_synonyms": _scalar(texts.type_name, property_type=places.canonical_type),
    "io_roundtrip": io_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "silver_csv": silver_csv,
    "url_list_roundtrip": url_list_roundtrip,
    "stream_available_now": stream_available_now,
    "stream_best": stream_best,
}
