"""Test inputs made from the ``orders`` table: listing pages, result pages, dirty RAW, value texts.

Expected values follow from ``o_orderkey`` (k), ``o_custkey`` (cu) and ``o_totalprice`` by the same
rules, never from the rendered text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickrow import lookups

SITE = "https://listings.example.org"
NARROW = "\N{NARROW NO-BREAK SPACE}"
HARD = "\N{NO-BREAK SPACE}"
SLUGS = ["apartment", "villa", "master-house", "flat-studio", "residence", "loft", "duplex", "Penthouse"]


def pick(mod: int, *cases: Column | str | None) -> Column:
    """The case with the number ``k % mod``; the last one counts for the rest."""
    k = F.col("k") % mod
    out = F.when(k == 0, cases[0])
    for i, case in enumerate(cases[1:-1], 1):
        out = out.when(k == i, case)
    return out.otherwise(cases[-1])


def cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def num(expression: str) -> Column:
    return F.expr(f"cast({expression} as bigint)").cast("string")


def keyed(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("cu"), F.col("o_totalprice").alias("total")
    )


def slug() -> Column:
    return F.element_at(F.array(*map(F.lit, SLUGS)), (F.col("k") % 8 + 1).cast("int"))


def listing_path() -> Column:
    return cat("/en/detail/", slug(), "/for-sale/", num("k"))


def listing_url() -> Column:
    return cat(SITE, listing_path())


def postal() -> Column:
    return F.lpad(num("(k * 37) % 10000"), 4, "0")


def price_number() -> Column:
    return F.when(F.col("k") % 20 == 0, F.floor(F.col("total") * 100)).otherwise(F.floor("total"))


def price_text() -> Column:
    gap = F.when(F.col("k") % 3 == 0, NARROW).otherwise(" ")
    spaced = F.replace(F.format_number(price_number(), 0), F.lit(","), gap)
    return F.when(F.col("k") % 33 == 0, "Price on request").otherwise(
        cat(spaced, gap, pick(2, "&euro;", "€"))
    )


def locality_text() -> Column:
    town = cat("Town", num("k % 100"))
    return F.when(F.col("k") % 41 == 0, town).otherwise(cat(postal(), pick(5, "&nbsp; ", " "), town))


def label_values() -> list[tuple[Column, Column]]:
    """(label, value) of the labelled fields; a null value means the pair is not on the page."""
    cadastral = cat(num("500 + k % 1000"), " €")
    return [
        (pick(2, "Build year", "Year of construction"), num("1700 + k % 400")),
        (F.lit("Number of bedrooms"), pick(6, "on request", None)),
        (F.lit("Number of bedrooms"), num("k % 7")),
        (F.lit("Number of bathrooms"), num("1 + k % 3")),
        (F.lit("Number of toilets"), pick(5, None, num("k % 4"))),
        (pick(3, "Livable surface", "Living area", "Habitable surface:"), cat(num("30 + cu % 400"), " m²")),
        (F.lit("Total land surface"), pick(2, cat(num("100 + k % 900"), " m²"), None)),
        (F.lit("Surface terrace"), pick(5, "12,5 m²", "1 200 m²", None)),
        (F.lit("Surface garden"), pick(7, cat(num("k % 50"), "m²"), None)),
        (
            pick(11, "EPC", "PEB", "Specific primary energy consumption"),
            pick(11, "B", cat(num("k % 600"), " kWh/m²/year")),
        ),
        (
            pick(2, "State of the property", "Condition"),
            pick(6, "Good", "To renovate", "1000 Brussels", "x" * 61, "Not specified", None),
        ),
        (F.lit("Currently leased"), pick(4, "Yes", "No", "unknown", "maybe")),
        (F.lit("Swimming pool"), pick(10, "Yes", None)),
        (F.lit("Type of heating"), pick(9, "90", "Gas")),
        (
            pick(8, "Cadastral income (not indexed)", "Cadastral estimate", None, None, "CADASTRAL Income:", "Cadastral estimate"),
            pick(4, cadastral, cadastral, None),
        ),
        # A second valid value of a field that is there already; the first one counts.
        (F.lit("Build year"), pick(3, "1850", None)),
        (F.lit("Swimming pool"), F.when(F.col("k") % 20 == 0, "No")),
    ]


def _pair(label: Column, value: Column) -> Column:
    """The value beside the heading, beside the heading's parent, or a few elements further on."""
    return pick(
        3,
        cat('<div class="row"><h4>', label, "</h4> <p>", value, "</p></div>"),
        cat('<div class="cell"><div><h4>', label, "</h4></div>\n<div>", value, "</div></div>"),
        cat("<section><div><div><h4>", label, "</h4></div></div><br><i></i><span>", value, "</span></section>"),
    )


def listing_pages(orders: DataFrame) -> DataFrame:
    """One listing page per order as ``page_id, url, html``."""
    pairs = F.concat(*[F.coalesce(_pair(label, value), F.lit("")) for label, value in label_values()])
    note = pick(4, "", "", cat("<p>Cadastral  revenue: ", num("500 + k % 1000"), " € a year<p>"), "")
    code = F.when(F.col("k") % 50 == 0, "").otherwise(cat('<b class="vlancode x">V', num("cu"), "</b>"))
    told = F.when(F.col("k") % 8 == 6, note).otherwise("")
    untold = F.when(F.col("k") % 8 == 6, "").otherwise(note)
    block = F.when(
        F.col("k") % 13 == 0,
        cat("<div><h3>More information</h3><p>Ask the agent</p></div><div>", pairs, note, "</div>"),
    ).otherwise(
        pick(
            2,
            cat("<div><h2> MORE <i>Information</i></h2>", pairs, told, "</div>", untold),
            cat("<div>", pairs, note, "</div>"),
        )
    )
    html = cat(
        '<!DOCTYPE html><html><head><script>var t="</p><h4>Build year</h4><p>1</p>";</script></head><body>',
        '<h4 class="x">Number of bedrooms</h4><p>99</p>',
        code,
        '<div><span class="detail__header_price_data">',
        price_text(),
        '</span><!-- <div class="city-line">no</div> --></div><div class="a  city-line b">',
        locality_text(),
        '</div><div class="city-line">9999 Second</div>',
        block,
        "</body></html>",
    )
    return keyed(orders).select(F.col("k").alias("page_id"), listing_url().alias("url"), html.alias("html"))


def recrawled_pages(orders: DataFrame) -> DataFrame:
    """Later versions of listing pages: every fifth at half the price; every seventh failed, half of those with a status."""
    cheaper = listing_pages(orders.where("o_orderkey % 5 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 0.5))
    cheaper = cheaper.select((F.col("page_id") + LATER).alias("page_id"), "url", "html", F.lit(200).alias("status"))
    gone = listing_pages(orders.where("o_orderkey % 7 = 0")).withColumn("page_id", F.col("page_id") + 2 * LATER)
    answered = gone.where("page_id % 2 = 0").withColumn("status", F.lit(404))
    # Two sets of rows, as a condition around the html would be too long to compile.
    empty = gone.where("page_id % 2 = 1").withColumns({"html": F.lit(None).cast("string"), "status": F.lit(None).cast("int")})
    return cheaper.unionByName(answered).unionByName(empty)


LATER = 1_000_000_000
CARDS_PER_PAGE = 20


def result_pages(orders: DataFrame) -> DataFrame:
    """Result pages of up to 20 orders each as ``page_id, url, html``; every fourth has no cards."""
    cards = cat('<div class="card"><h2 class="', lookups.CARD_CLASS, '">')
    card = pick(
        10,
        cat(cards, "no link</h2></div>"),
        cat(cards, '<a href="', listing_url(), '">x</a></h2></div>'),
        cat(cards, '<a href="/en/projectdetail/', num("k"), '">x</a></h2></div>'),
        cat(cards, '<a href="/en/detail/', F.lit("loft/for-sale/"), num("k div 100"), '">x</a><a href="/z">z</a></h2></div>'),
        cat('<h2 class="ellipsis card-title pr-2 mt-1 mb-0"><a href="', listing_path(), '">x</a></h2>'),
        cat(cards, '<span><a href="../x/./../', F.substr(listing_path(), F.lit(2)), '">x</a></span></h2></div>'),
        cat(cards, '<a href="', listing_path(), '">x</a></h2></div>'),
    )
    anchor = pick(
        4,
        cat('<a href="/en/detail/sale/house/', num("k div 8"), '">x</a>'),
        cat('<a href="', SITE, "/en/detail/sale/house/", num("k div 8"), '">x</a>'),
        "<a>none</a>",
        '<a href="/en/detail/rent/house/3">x</a>',
    )
    pieces = keyed(orders).select(
        F.expr(f"k div {CARDS_PER_PAGE}").alias("page_id"),
        "k",
        F.when(F.expr(f"k div {CARDS_PER_PAGE}") % 4 == 3, anchor).otherwise(card).alias("piece"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("k", "piece")))  # at most 20 per page
    body = F.array_join(F.transform(ordered, lambda c: c.piece), "\n")
    pages = pieces.groupBy("page_id").agg(cat("<html><body>", body, "</body></html>").alias("html"))
    return pages.select("page_id", cat(SITE, "/search/", F.col("page_id").cast("string")).alias("url"), "html")


def dirty_raw(orders: DataFrame) -> DataFrame:
    """RAW as untidy text; every 17th record appears a second time under another code."""
    k, columns = F.col("k"), {}
    columns["property_url"] = pick(4, cat(HARD, " ", listing_url(), " "), listing_url())
    columns["property_code"] = F.when(k % 50 == 0, None).when(k % 50 == 1, " n/a ").otherwise(cat("V", num("cu")))
    columns["property_type"] = pick(8, "apartment", " Villa ", "MASTER", "master-house", "Residence", "loft", "-", None)
    shown = price_number().cast("string")
    columns["price_eur"] = F.when(k % 33 == 0, None).otherwise(
        pick(4, cat(shown, ".0"), cat(shown, ",75"), cat(F.substr(shown, F.lit(1), F.lit(2)), NARROW, F.substr(shown, F.lit(3)), " EUR"), shown)
    )
    columns["cadastral_income_eur"] = pick(5, "Unknown", "1.2.3", num("500 + k % 1000"))
    columns["postal_code"] = F.when(k % 41 == 0, None).otherwise(pick(3, cat("B-", postal()), cat(postal(), "0"), postal()))
    columns["locality_name"] = pick(4, "Saint-Gilles \N{LATIN SMALL LIGATURE FI}n", cat("Town", HARD, HARD, num("k % 100")), "NULL", "Li\N{LATIN SMALL LETTER E WITH GRAVE}ge")
    columns["state_of_the_property"] = pick(6, "Good", " To  renovate", "--", "Not Specified", "unknown", None)
    columns["currently_leased"] = pick(7, "1", "0", "TRUE", "n", "unknown", " Yes ", None)
    columns["build_year"] = cat(num("1700 + k % 400"), ".0")
    columns["bedrooms"] = F.when(k % 43 == 0, "9" * 25).otherwise(num("k % 7"))
    columns["bathrooms"] = pick(6, "2 rooms", "none", "3")
    columns["toilets"] = pick(4, "-", "1.9", "-2", "4")
    columns["livable_surface_m2"] = cat(num("30 + cu % 400"), pick(2, ".5", ""))
    columns["total_land_surface_m2"] = pick(2, cat(num("100 + k % 900"), " m"), None)
    columns["terrace_m2"] = pick(5, "12,5", "1 200", None)
    columns["garden_m2"] = F.when(k % 37 == 0, "0032 475 12 34 56 / 0032 475 65 43 21").otherwise(pick(3, "N/A", num("k % 50")))
    columns["heating_type"] = F.lit("Gas")
    columns["epc_kwh_m2_year"] = pick(11, "B", num("k % 600"))
    columns["swimming_pool"] = pick(5, "yes", "False", "No", "Y", "maybe")
    rows = keyed(orders).select(
        F.explode(F.when(k % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"), "k", "cu", "total"
    )
    columns["property_code"] = F.when(F.col("copy") == 1, cat("D", num("k"))).otherwise(columns["property_code"])
    return rows.select(*[c.cast("string").alias(name) for name, c in columns.items()])


def json_records(orders: DataFrame) -> DataFrame:
    """One JSON text for each order, ``record``, with ragged keys; every 19th is cut short."""
    price = pick(
        5,
        "",
        cat(',"price_eur":"', num("floor(total)"), '"'),
        cat(',"price_eur":', num("floor(total)"), ".9"),
        ',"price_eur":{"amount":1}',
        cat(',"price_eur":', num("floor(total)")),
    )
    bedrooms = pick(4, cat(',"bedrooms":', num("k % 7")), cat(',"bedrooms":"', num("k % 7"), '"'), ',"bedrooms":null', ',"bedrooms":"some"')
    heating = pick(3, ',"heating_type":"Gas"', cat(',"heating_type":', num("k % 9")), ',"heating_type":["Gas"]')
    extra = pick(2, ',"agent":{"name":"x","phones":[1,2]}', "")
    record = cat('{"property_url":"', listing_url(), '"', price, bedrooms, heating, extra, F.when(F.col("k") % 19 == 0, "").otherwise("}"))
    return keyed(orders).select(record.alias("record"))
