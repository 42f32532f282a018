"""URL frontier: search pages, links of result pages, staging, limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brickrow import lookups
from brickrow.functions import links
from brickrow.functions.text import strip
from brickrow.operators import html
from brickrow.operators.distinct import first_row, first_seen
from brickrow.selectors import Selector


def search_pages(provinces: DataFrame, base_url: str) -> DataFrame:
    """Search URLs of pages 1..``n_pages`` for every row of ``(province_no, province, n_pages)``.

    The order of the crawl is ``province_no, page``.
    """
    before, rest = lookups.SEARCH_QUERY.split("{province}")
    middle, after = rest.split("{page}")
    page = F.col("page").cast("string")
    url = F.concat(F.lit(base_url + before), F.col("province"), F.lit(middle), page, F.lit(after))
    numbered = provinces.where("n_pages > 0").select(
        "province_no", "province", F.explode(F.sequence(F.lit(1), F.col("n_pages").cast("int"))).alias("page")
    )
    return numbered.select("*", url.alias("listing_url"))


def all_search_pages(spark: SparkSession, base_url: str, max_pages: int = 50) -> DataFrame:
    """Search URLs of the first ``max_pages`` pages of every province."""
    rows = [(i, slug, max_pages) for i, slug in enumerate(lookups.PROVINCE_SLUGS)]
    return search_pages(spark.createDataFrame(rows, "province_no int, province string, n_pages int"), base_url)


CARD = Selector("card", cls=lookups.CARD_CLASS, wants=("link",))
ANCHOR = Selector("anchor", tags=("a",), href_with="", wants=("href",))
SALE = Selector("sale", tags=("a",), href_with=lookups.SALE_DETAIL_MARK, wants=("href",))


def _exploded(pages: DataFrame, selector: Selector, field: str) -> DataFrame:
    keys = [c for c in pages.columns if c != "html"]
    found = html.select_nodes(pages, [selector])
    return found.select(*keys, F.posexplode(F.col(f"marks.{field}")).alias("pos", "href"))


def anchor_links(pages: DataFrame) -> DataFrame:
    """Every ``<a href>`` in document order as ``pos, href``; other columns are kept."""
    return _exploded(pages, ANCHOR, "href")


def card_links(pages: DataFrame) -> DataFrame:
    """First link inside each result card; null where the card has none."""
    return _exploded(pages, CARD, "link")


def card_links_or_anchors(pages: DataFrame, base_url: str) -> DataFrame:
    """Card links, or on a page without cards its distinct links to sale pages."""
    keys = [c for c in pages.columns if c != "html"]
    selectors = [CARD, SALE]
    marks = html.select_nodes(pages, selectors)
    found = marks.select(
        *keys,
        F.transform(html.marked(selectors, "card"), lambda m: m.link).alias("cards"),
        F.transform(html.marked(selectors, "sale"), lambda m: m.href).alias("sale"),
    )

    def absolute(hrefs: Column) -> Column:
        return F.transform(hrefs, lambda h: links.root_relative(h, base_url))

    named = F.filter("cards", lambda h: F.coalesce(h != "", F.lit(False)))
    chosen = F.when(F.size("cards") > 0, absolute(named)).otherwise(F.array_distinct(absolute(F.col("sale"))))
    return found.select(*keys, F.posexplode(chosen).alias("pos", "href"))


def normalize_links(table: DataFrame, base_url: str, href: str = "href") -> DataFrame:
    """Add ``url``, the absolute form of ``href``."""
    return table.withColumn("url", links.resolve_link(F.col(href), base_url))


def keep_details(table: DataFrame, url: str = "url") -> DataFrame:
    return table.where(links.is_detail(F.col(url)))


def collect_urls(result_pages: DataFrame, base_url: str) -> DataFrame:
    """Detail URLs of the result pages ``(page_id, html)``, each with its first page and place.

    A URL is made unique inside its page before anything is shuffled, and ``page_id`` names one
    page, so the first place is an aggregate over plain numbers.
    """
    resolved = F.transform(F.col("marks.link"), lambda h: links.resolve_link(h, base_url))
    details = F.filter(resolved, lambda u: F.coalesce(links.is_detail(u), F.lit(False)))
    per_page = html.select_nodes(result_pages.select("page_id", "html"), [CARD]).select(
        "page_id", F.posexplode(F.array_distinct(details)).alias("pos", "url")
    )
    return per_page.groupBy("url").agg(
        F.min("page_id").alias("first_page"), F.min_by("pos", "page_id").alias("first_pos")
    )


def load_urls(table: DataFrame, limit: int | None = None, url: str | None = None, seq: str = "seq") -> DataFrame:
    """Trimmed distinct detail URLs of a URL table, as ``url, first_seen``.

    The column is ``link``, else ``url``, else the first. ``limit`` takes the first rows of the
    table in ``seq`` order, before any filter.
    """
    plain = [c for c in table.columns if c != seq]
    name = url or next((c for c in ("link", "url") if c in plain), plain[0])
    rows = table if limit is None else table.orderBy(seq).limit(limit)
    trimmed = rows.select(strip(F.col(name)).alias("url"), F.col(seq).alias("seq"))
    return first_seen(keep_details(trimmed.where("url <> ''")))


def take_first(frontier: DataFrame, limit: int | None = None, order: str = "first_seen") -> DataFrame:
    """The first ``limit`` URLs; none or 0 takes all."""
    return frontier.orderBy(order).limit(limit) if limit else frontier


def stage_urls(table: DataFrame, seq: str = "seq") -> DataFrame:
    """Sale and project pages, the first row of every URL with its other columns."""
    return first_row(table.where(links.is_staged(F.col("url"))), ["url"], [F.asc(seq)])


def stage_distinct(table: DataFrame) -> DataFrame:
    return table.distinct()


def staging_counts(table: DataFrame) -> DataFrame:
    """Rows before staging, rows that pass the filter, URLs staged, distinct URLs without filter."""
    per_url = table.groupBy("url").agg(F.count("*").alias("n"))
    return per_url.withColumn("staged", links.is_staged(F.col("url"))).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum(F.when(F.col("staged"), F.col("n"))), F.lit(0)).alias("n_passed"),
        F.count_if("staged").alias("n_staged"),
        F.count("*").alias("n_distinct"),
    )


def not_yet_scraped(frontier: DataFrame, raw: DataFrame) -> DataFrame:
    """Frontier URLs of which RAW has no record yet. A URL that failed is offered again.

    RAW keeps a failed URL with nothing but its ``property_url``.
    """
    values = [c for c in raw.columns if c not in ("property_url", "scraping_error")]
    read = F.coalesce(*[F.col(c).cast("string") for c in values]).isNotNull() if values else F.lit(True)
    if "scraping_error" in raw.columns:
        read = ~F.col("scraping_error")
    return frontier.join(raw.where(read).select(F.col("property_url").alias("url")), "url", "left_anti")
