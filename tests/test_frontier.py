from brickrow.lookups import PROVINCE_SLUGS
from brickrow.operators import frontier

SITE = "https://site.example"
STAGING = [
    (1, f"{SITE}/en/detail/sale/house/1", "a"),
    (2, f"{SITE}/en/projectdetail/2", "b"),
    (3, f"{SITE}/en/detail/sale/house/1", "c"),
    (4, f"{SITE}/en/detail/rent/house/3", "d"),
    (5, None, "e"),
]


def staging(spark):
    return spark.createDataFrame(STAGING, "seq int, url string, note string")


def test_search_pages_of_every_province(spark):
    pages = frontier.all_search_pages(spark, SITE, max_pages=3).orderBy("province_no", "page").collect()
    assert [r.province for r in pages] == [slug for slug in PROVINCE_SLUGS for _ in range(3)]
    assert pages[4].listing_url == (
        f"{SITE}/en/real-estate?transactiontypes=for-sale,in-public-sale&propertytypes=house,apartment"
        "&provinces=vlaams-brabant&islifeannuity=no&page=2&noindex=1"
    )
    assert frontier.all_search_pages(spark, SITE).count() == 550
    assert frontier.all_search_pages(spark, SITE, 0).count() == 0


def test_staging_keeps_sales_and_projects_once(spark):
    staged = frontier.stage_urls(staging(spark)).orderBy("seq").collect()
    assert [(r.seq, r.note) for r in staged] == [(1, "a"), (2, "b")]
    assert not any("rent" in r.url for r in staged)
    assert frontier.staging_counts(staging(spark)).first() == (5, 3, 2, 4)
    assert frontier.staging_counts(staging(spark).limit(0)).first() == (0, 0, 0, 0)
    assert frontier.stage_distinct(staging(spark).select("url")).count() == 4


def test_load_urls(spark):
    hard = "\N{NO-BREAK SPACE}"
    rows = [(1, "x"), (2, f" {SITE}/en/detail/b{hard}"), (3, f"{SITE}/en/detail/a"), (4, f"{SITE}/en/detail/b"), (5, " "), (6, None)]
    table = spark.createDataFrame(rows, "seq int, link string")
    loaded = frontier.load_urls(table).orderBy("first_seen").collect()
    assert [tuple(r) for r in loaded] == [(f"{SITE}/en/detail/b", 2), (f"{SITE}/en/detail/a", 3)]
    # The first limit counts rows of the table, the second URLs of the frontier.
    assert [r.first_seen for r in frontier.load_urls(table, limit=2).collect()] == [2]
    assert [r.first_seen for r in frontier.take_first(frontier.load_urls(table), 1).collect()] == [2]
    assert frontier.take_first(frontier.load_urls(table), 0).count() == 2


def test_load_urls_picks_the_column(spark):
    both = spark.createDataFrame([("x", f"{SITE}/en/detail/l", f"{SITE}/en/detail/u", 1)], "a string, link string, url string, seq int")
    assert frontier.load_urls(both).first().url.endswith("/l")
    assert frontier.load_urls(both.drop("link")).first().url.endswith("/u")
    first = both.select(both.url.alias("first"), "a", "seq")
    assert frontier.load_urls(first).first().url.endswith("/u")


def test_not_yet_scraped(spark):
    urls = spark.createDataFrame([("a",), ("b",)], "url string")
    raw = spark.createDataFrame([("b",), (None,)], "property_url string")
    assert [r.url for r in frontier.not_yet_scraped(urls, raw).collect()] == ["a"]
