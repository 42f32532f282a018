"""The same results in DuckDB SQL, computed from the table columns and not from rendered text."""

from __future__ import annotations

SITE = "https://listings.example.org"
CARD_SLUGS = "['apartment','villa','master-house','flat-studio','residence','loft','duplex','Penthouse']"

# Unicode white space for RE2, and the same for chr() where a text is built.
WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

O = f"""o AS (
  SELECT o_orderkey AS k, o_custkey AS cu, o_totalprice AS total, o_orderstatus AS status,
    '/en/detail/' || {CARD_SLUGS}[o_orderkey % 8 + 1] || '/for-sale/' || o_orderkey AS path,
    '{SITE}/en/detail/' || {CARD_SLUGS}[o_orderkey % 8 + 1] || '/for-sale/' || o_orderkey AS url,
    lpad(CAST((o_orderkey * 37) % 10000 AS VARCHAR), 4, '0') AS postal,
    CAST(CASE WHEN o_orderkey % 20 = 0 THEN floor(o_totalprice * 100) ELSE floor(o_totalprice) END AS BIGINT) AS price
  FROM orders)"""


def province(postal: str) -> str:
    z = f"CAST({postal} AS INTEGER)"
    return f"""CASE WHEN {postal} IS NULL THEN 'Unknown'
      WHEN {z} < 1000 THEN 'Outside Belgium / Invalid'
      WHEN {z} < 1300 THEN 'Brussels'
      WHEN {z} < 1500 THEN 'Walloon Brabant'
      WHEN {z} < 2000 OR ({z} >= 3000 AND {z} < 3500) THEN 'Flemish Brabant'
      WHEN {z} < 3000 THEN 'Antwerp'
      WHEN {z} < 4000 THEN 'Limburg'
      WHEN {z} < 5000 THEN 'Liège'
      WHEN {z} < 6000 THEN 'Namur'
      WHEN {z} < 6600 OR ({z} >= 7000 AND {z} < 8000) THEN 'Hainaut'
      WHEN {z} < 7000 THEN 'Luxembourg'
      WHEN {z} < 9000 THEN 'West Flanders'
      ELSE 'East Flanders' END"""


RAW = f"""{O}, raw AS (
  SELECT k, url AS property_url,
    CASE WHEN k % 50 <> 0 THEN 'V' || cu END AS property_code,
    ['apartment','house','house','studio','house','loft','duplex','penthouse'][k % 8 + 1] AS property_type,
    CASE WHEN k % 33 <> 0 THEN price END AS price_eur,
    CASE WHEN k % 4 < 3 THEN 500 + k % 1000 END AS cadastral_income_eur,
    CASE WHEN k % 41 <> 0 THEN postal END AS postal_code,
    'Town' || (k % 100) AS locality_name,
    CASE k % 6 WHEN 0 THEN 'Good' WHEN 1 THEN 'To renovate' WHEN 4 THEN 'Not specified' END AS state_of_the_property,
    CASE k % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'No' END AS currently_leased,
    1700 + k % 400 AS build_year,
    k % 7 AS bedrooms,
    1 + k % 3 AS bathrooms,
    CASE WHEN k % 5 <> 0 THEN k % 4 END AS toilets,
    30 + cu % 400 AS livable_surface_m2,
    CASE WHEN k % 2 = 0 THEN 100 + k % 900 END AS total_land_surface_m2,
    CAST(CASE k % 5 WHEN 0 THEN 5 WHEN 1 THEN 200 END AS BIGINT) AS terrace_m2,
    CASE WHEN k % 7 = 0 THEN k % 50 END AS garden_m2,
    CASE WHEN k % 9 <> 0 THEN 'Gas' END AS heating_type,
    CASE WHEN k % 11 <> 0 THEN k % 600 END AS epc_kwh_m2_year,
    CASE WHEN k % 10 = 0 THEN 'Yes' END AS swimming_pool
  FROM o)"""

# Cleaned records before the choice of the best, from the rendered pages ...
PAGE_ROWS = f"""{RAW}, cleaned AS (
  SELECT * EXCLUDE (k, heating_type) REPLACE (
    nullif(state_of_the_property, 'Not specified') AS state_of_the_property,
    lower(currently_leased) AS currently_leased,
    lower(swimming_pool) AS swimming_pool,
    CASE WHEN build_year BETWEEN 1800 AND 2026 THEN build_year END AS build_year),
    {province("postal_code")} AS province
  FROM raw WHERE price_eur BETWEEN 10000 AND 7500000)"""

# ... and from the dirty records. Prices stay fractional up to the end.
DIRTY_ROWS = f"""{O}, copies AS (
  SELECT *, unnest(CASE WHEN k % 17 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM o),
priced AS (
  SELECT *, CASE WHEN k % 33 = 0 THEN NULL WHEN k % 4 = 1 THEN price + 0.75 ELSE CAST(price AS DOUBLE) END AS p FROM copies),
cleaned AS (
  SELECT url AS property_url,
    CASE WHEN copy = 1 THEN 'D' || k WHEN k % 50 > 1 THEN 'V' || cu END AS property_code,
    ['apartment','house','house','house','house','loft',NULL,NULL][k % 8 + 1] AS property_type,
    p AS price_eur,
    CASE WHEN k % 5 > 1 THEN 500 + k % 1000 END AS cadastral_income_eur,
    CASE WHEN k % 41 <> 0 THEN postal END AS postal_code,
    CASE k % 4 WHEN 0 THEN 'Saint-Gilles fin' WHEN 1 THEN 'Town ' || (k % 100) WHEN 3 THEN 'Liège' END AS locality_name,
    CASE k % 6 WHEN 0 THEN 'Good' WHEN 1 THEN 'To renovate' END AS state_of_the_property,
    ['yes','no','yes','no',NULL,'yes',NULL][k % 7 + 1] AS currently_leased,
    CASE WHEN k % 400 BETWEEN 100 AND 326 THEN 1700 + k % 400 END AS build_year,
    CASE WHEN k % 43 > 0 THEN k % 7 END AS bedrooms,
    CAST([2,NULL,3,3,3,3][k % 6 + 1] AS BIGINT) AS bathrooms,
    CAST([NULL,1,-2,4][k % 4 + 1] AS BIGINT) AS toilets,
    30 + cu % 400 AS livable_surface_m2,
    CASE WHEN k % 2 = 0 THEN 100 + k % 900 END AS total_land_surface_m2,
    CAST(CASE k % 5 WHEN 0 THEN 12 WHEN 1 THEN 1200 END AS BIGINT) AS terrace_m2,
    CASE WHEN k % 3 > 0 AND k % 37 > 0 THEN k % 50 END AS garden_m2,
    CASE WHEN k % 11 <> 0 THEN k % 600 END AS epc_kwh_m2_year,
    ['yes','no','no','yes',NULL][k % 5 + 1] AS swimming_pool,
    {province("CASE WHEN k % 41 <> 0 THEN postal END")} AS province
  FROM priced WHERE p >= 10000 AND p <= 7500000)"""

BEST = """per_code AS (
  SELECT * FROM cleaned QUALIFY row_number() OVER (
    PARTITION BY property_code ORDER BY price_eur DESC, property_url ASC NULLS LAST) = 1),
silver AS (
  SELECT * REPLACE (CAST(trunc(price_eur) AS BIGINT) AS price_eur) FROM per_code QUALIFY row_number() OVER (
    PARTITION BY property_url ORDER BY price_eur DESC, property_code ASC NULLS LAST) = 1)"""

DIRTY_SILVER = f"WITH {DIRTY_ROWS}, {BEST}"

RAW_COLUMNS = "* EXCLUDE (k)"
SILVER_TYPES = {
    "property_url": "string",
    "property_code": "string",
    "property_type": "string",
    "price_eur": "bigint",
    "cadastral_income_eur": "bigint",
    "postal_code": "string",
    "locality_name": "string",
    "state_of_the_property": "string",
    "currently_leased": "string",
    "build_year": "bigint",
    "bedrooms": "bigint",
    "bathrooms": "bigint",
    "toilets": "bigint",
    "livable_surface_m2": "bigint",
    "total_land_surface_m2": "bigint",
    "terrace_m2": "bigint",
    "garden_m2": "bigint",
    "epc_kwh_m2_year": "bigint",
    "swimming_pool": "string",
    "province": "string",
}

ANCHORS = """anchors AS (
  SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS pos, unnest(h) AS href
  FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages))"""

# Character references that occur in the pages; '&amp' may lack its semicolon.
def decoded(expression: str) -> str:
    for reference, character in [("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]:
        expression = f"replace({expression}, '{reference}', '{character}')"
    return f"replace({expression}, '&amp', '&')"


def squeezed(expression: str) -> str:
    return f"nullif(trim(regexp_replace({expression}, '{WS}+', ' ', 'g')), '')"


# Result cards: 20 per page, every fourth page without cards.
CARDS = f"""{O}, cards AS (
  SELECT k // 20 AS page_id, k, CASE k % 10
      WHEN 0 THEN NULL
      WHEN 1 THEN url
      WHEN 2 THEN '/en/projectdetail/' || k
      WHEN 3 THEN '/en/detail/loft/for-sale/' || (k // 100)
      WHEN 5 THEN '../x/./../' || path[2:]
      ELSE path END AS href
  FROM o WHERE (k // 20) % 4 < 3 AND k % 10 <> 4),
numbered AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INTEGER) AS pos, href, k FROM cards)"""

STAGED = """spelled AS (
  SELECT page_id * 4 AS seq, url, 0 AS kind FROM pages
  UNION ALL SELECT page_id * 4 + 1, replace(url, '/en/', '/en/detail/Sale/'), 1 FROM pages
  UNION ALL SELECT page_id * 4 + 2, replace(url, '/en/', '/en/projectDetail/'), 2 FROM pages
  UNION ALL SELECT page_id * 4 + 3, replace(url, '/en/', '/en/detail/Sale/'), 3 FROM pages)"""
IS_STAGED = "regexp_matches(url, '/sale/|projectdetail', 'i')"


def scalar(expression: str, name: str, more: str = "") -> str:
    return f"WITH {O} SELECT k, {expression} AS {name}{more} FROM o"


def recrawled(rows: str) -> str:
    """The same rows where every fifth listing was later found at half the price."""
    half = "CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice * 0.5 ELSE o_totalprice END AS o_totalprice"
    return rows.replace("FROM orders)", f"FROM (SELECT * REPLACE ({half}) FROM orders))")


N = "CAST(floor(total) AS BIGINT)"
AREA = "30 + cu % 400"

ORACLES: dict[str, str] = {
    "listings_by_province": f"""{DIRTY_SILVER}
SELECT province, count(*) AS n_listings, avg(price_eur) AS avg_price FROM silver GROUP BY province""",
    "silver": f"{DIRTY_SILVER} SELECT * FROM silver",
    "silver_no_code_kept": f"""WITH {DIRTY_ROWS}, coded AS (
  SELECT * FROM cleaned QUALIFY property_code IS NULL OR row_number() OVER (
    PARTITION BY property_code ORDER BY price_eur DESC, property_url) = 1),
best AS (SELECT * FROM coded QUALIFY row_number() OVER (
    PARTITION BY property_url ORDER BY price_eur DESC, property_code ASC NULLS LAST) = 1)
SELECT * REPLACE (CAST(trunc(price_eur) AS BIGINT) AS price_eur) FROM best""",
    "silver_without_postal": f"""{DIRTY_SILVER}
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS postal_code, 'Unknown' AS province) FROM silver""",
    "silver_from_pages": f"WITH {PAGE_ROWS}, {BEST} SELECT * FROM silver",
    "clean_rows": f"""WITH {DIRTY_ROWS}
SELECT province, count(*) AS n_rows, count(build_year) AS n_years, count(property_type) AS n_types,
  count(state_of_the_property) AS n_states, sum(price_eur) AS sum_price
FROM cleaned GROUP BY province""",
    "top_head": f"""{DIRTY_SILVER}
SELECT property_url, property_code, price_eur, province FROM silver
ORDER BY price_eur DESC, property_url ASC NULLS LAST LIMIT 5""",
    "quality_gate": f"""{DIRTY_SILVER}
SELECT count(*) AS n_rows, count(*) FILTER (price_eur IS NULL) AS n_null_prices,
  count(*) FILTER (province = 'Outside Belgium / Invalid') AS n_outside FROM silver""",
    "gate_outcomes": f"""{DIRTY_SILVER}
SELECT 'good' AS table_name, count(*) || ' records pass' AS outcome FROM silver
UNION ALL SELECT 'empty', 'the cleaned table is empty'
UNION ALL SELECT 'no price', count(*) FILTER (bedrooms IS NULL OR bedrooms = 3) || ' records without a price' FROM silver""",
    "table_shape": f"""{DIRTY_SILVER}
SELECT count(*) AS n_rows, CAST({len(SILVER_TYPES)} AS BIGINT) AS n_columns, count(*) AS n_saved FROM silver""",
    "profile": f"{DIRTY_SILVER} "
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS column_type, count({c}) AS n_values FROM silver"
        for i, (c, t) in enumerate(SILVER_TYPES.items())
    ),
    "stored_profile": f"{DIRTY_SILVER} "
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS column_type, count({c}) AS n_values FROM silver"
        for i, (c, t) in enumerate(SILVER_TYPES.items())
    ),
    "frontier_urls": f"""WITH {O}, slugs AS (
  SELECT * FROM (VALUES ('Antwerp', 'antwerp', 0), ('Flemish Brabant', 'vlaams-brabant', 1),
    ('Walloon Brabant', 'brabant-wallon', 2), ('East Flanders', 'east-flanders', 3),
    ('West Flanders', 'west-flanders', 4), ('Hainaut', 'hainaut', 5), ('Brussels', 'brussels', 6),
    ('Liège', 'liege', 7), ('Limburg', 'limburg', 8), ('Namur', 'namur', 9),
    ('Luxembourg', 'luxembourg', 10)) AS s(name, province, province_no)),
counted AS (
  SELECT s.province, CAST(s.province_no AS BIGINT) AS province_no, CAST(ceil(count(*) / 20) AS BIGINT) AS n_pages
  FROM (SELECT {province("postal")} AS name FROM o) l JOIN slugs s ON l.name = s.name GROUP BY ALL),
paged AS (SELECT province_no, province, CAST(unnest(range(1, n_pages + 1)) AS INTEGER) AS page FROM counted)
SELECT province_no, province, page, '{SITE}/en/real-estate?transactiontypes=for-sale,in-public-sale'
  || '&propertytypes=house,apartment&provinces=' || province || '&islifeannuity=no&page=' || page
  || '&noindex=1' AS listing_url FROM paged""",
    "link_extract": f"WITH {ANCHORS} SELECT page_id, pos, href FROM anchors",
    "link_normalize": f"""WITH {ANCHORS}
SELECT page_id, pos, CAST(kind AS INTEGER) AS kind, CASE kind
    WHEN 0 THEN '{SITE}' || href
    WHEN 1 THEN '{SITE}' || href
    WHEN 2 THEN 'https://cdn.example.net' || href
    WHEN 3 THEN '{SITE}?page=' || pos
    WHEN 4 THEN '{SITE}/en' || href
    WHEN 5 THEN '{SITE}/en/detail' || href
    WHEN 6 THEN 'HTTP://Other.example.net' || href
    ELSE 'mailto:a@b' END AS url
FROM anchors, range(8) AS kinds(kind)""",
    "detail_links": f"""WITH {ANCHORS}
SELECT '{SITE}/en/detail' || href AS url, min(page_id) AS first_seen
FROM anchors WHERE pos % 2 = 0 GROUP BY href""",
    "card_links": f"WITH {CARDS} SELECT page_id, pos, href FROM numbered",
    "card_links_fallback": f"""WITH {CARDS}, named AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS pos,
    CASE WHEN href LIKE '/%' THEN '{SITE}' || href ELSE href END AS href
  FROM cards WHERE href IS NOT NULL),
loose AS (
  SELECT k // 20 AS page_id, min(k) AS k, '{SITE}/en/detail/sale/house/' || (k // 8) AS href
  FROM o WHERE (k // 20) % 4 = 3 AND k % 4 < 2 GROUP BY 1, 3)
SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM named
UNION ALL SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INTEGER), href FROM loose""",
    "collect_urls": f"""WITH {CARDS}, resolved AS (
  SELECT page_id, k, CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '/%' THEN '{SITE}' || href
    ELSE '{SITE}/' || replace(href, '../x/./../', '') END AS url
  FROM cards WHERE href NOT LIKE '%projectdetail%'),
once AS (SELECT page_id, url, min(k) AS k FROM resolved GROUP BY page_id, url),
placed AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS pos FROM once)
SELECT url, min(page_id) AS first_page, CAST(arg_min(pos, page_id) AS INTEGER) AS first_pos FROM placed GROUP BY url""",
    "url_stage": f"""WITH {STAGED}
SELECT seq, url, kind FROM spelled WHERE {IS_STAGED}
QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq) = 1""",
    "url_stage_distinct": f"WITH {STAGED} SELECT DISTINCT url FROM spelled",
    "staging_counts": f"""WITH {STAGED}
SELECT count(*) AS n_before, count(*) FILTER ({IS_STAGED}) AS n_passed,
  count(DISTINCT url) FILTER ({IS_STAGED}) AS n_staged, count(DISTINCT url) AS n_distinct FROM spelled""",
    "load_urls": f"""WITH {STAGED}
SELECT url, min(seq) AS first_seen FROM spelled WHERE contains(url, '/en/detail/') GROUP BY url""",
    "url_limit": f"""WITH {STAGED}, firsts AS (SELECT * FROM spelled ORDER BY seq LIMIT 120)
SELECT url, min(seq) AS first_seen FROM firsts WHERE contains(url, '/en/detail/')
GROUP BY url ORDER BY first_seen LIMIT 10""",
    "staged_files": f"""WITH {STAGED}, counts AS (
  SELECT count(*) AS n_before, count(*) FILTER ({IS_STAGED}) AS n_passed,
    count(DISTINCT url) FILTER ({IS_STAGED}) AS n_staged, count(DISTINCT url) AS n_distinct,
    count(*) AS all_before, count(DISTINCT (url, kind)) AS all_after, CAST(0 AS BIGINT) AS missing, CAST(1 AS BIGINT) AS missing_raises
  FROM spelled)
UNPIVOT counts ON COLUMNS(*) INTO NAME url VALUE n
UNION ALL SELECT url, CAST(kind AS BIGINT) AS n FROM spelled WHERE {IS_STAGED}
QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq) = 1""",
    "incremental_frontier": f"WITH {O} SELECT url FROM o WHERE status <> 'F'",
    "page_class_text": f"""SELECT page_id,
  {squeezed(decoded("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)"))} AS ad_text FROM pages""",
    "page_heading": f"""SELECT page_id,
  {squeezed(decoded("regexp_extract(html, '<h1>([^<]*)</h1>', 1)"))} AS heading FROM pages""",
    "page_text": f"""WITH t AS (SELECT page_id, {squeezed(decoded(
        "regexp_replace(html, '<script>.*?</script>|<style>.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'gs')"
    ))} AS t FROM pages)
SELECT page_id, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS n_chars FROM t""",
    "page_outcomes": f"""WITH {ANCHORS}, latest AS (SELECT url, max(page_id) % 10 = 0 AS failed FROM pages GROUP BY url)
SELECT false AS scraping_error, count(*) AS n_urls FROM latest WHERE NOT failed
UNION ALL SELECT true, (SELECT count(DISTINCT href) FROM anchors) + (SELECT count(*) FROM latest WHERE failed)""",
    "h4_pairs": f"""WITH {RAW}
SELECT k AS page_id, 'build_year' AS field, CAST(build_year AS VARCHAR) AS value FROM raw
UNION ALL SELECT k, 'bedrooms', CAST(bedrooms AS VARCHAR) FROM raw
UNION ALL SELECT k, 'bathrooms', CAST(bathrooms AS VARCHAR) FROM raw
UNION ALL SELECT k, 'toilets', CAST(toilets AS VARCHAR) FROM raw WHERE toilets IS NOT NULL
UNION ALL SELECT k, 'livable_surface_m2', livable_surface_m2 || ' m²' FROM raw
UNION ALL SELECT k, 'total_land_surface_m2', total_land_surface_m2 || ' m²' FROM raw WHERE k % 2 = 0
UNION ALL SELECT k, 'terrace_m2', CASE k % 5 WHEN 0 THEN '12,5 m²' ELSE '1 200 m²' END FROM raw WHERE k % 5 < 2
UNION ALL SELECT k, 'garden_m2', garden_m2 || 'm²' FROM raw WHERE k % 7 = 0
UNION ALL SELECT k, 'epc_kwh_m2_year', epc_kwh_m2_year || ' kWh/m²/year' FROM raw WHERE k % 11 > 0
UNION ALL SELECT k, 'state_of_the_property', state_of_the_property FROM raw WHERE state_of_the_property IS NOT NULL
UNION ALL SELECT k, 'currently_leased', ['Yes','No','unknown'][k % 4 + 1] FROM raw WHERE k % 4 < 3
UNION ALL SELECT k, 'swimming_pool', 'Yes' FROM raw WHERE k % 10 = 0
UNION ALL SELECT k, 'heating_type', 'Gas' FROM raw WHERE k % 9 > 0
UNION ALL SELECT k, 'cadastral_income_eur', cadastral_income_eur || ' €' FROM raw WHERE k % 4 < 2""",
    "cadastral_fallback": f"WITH {RAW} SELECT k AS page_id, cadastral_income_eur FROM raw",
    "raw_records": f"""WITH {RAW}, gone AS (SELECT url || '/gone' AS property_url FROM o)
SELECT {RAW_COLUMNS} FROM raw UNION ALL BY NAME SELECT property_url FROM gone""",
    "scrape_new": f"""WITH {RAW.replace("FROM o)", "FROM o WHERE status <> 'F')")} SELECT {RAW_COLUMNS} FROM raw""",
    "scrape_new_bucketed": f"""WITH {RAW.replace("FROM o)", "FROM o WHERE status <> 'F')")} SELECT {RAW_COLUMNS} FROM raw""",
    "append_new": f"WITH {RAW} SELECT {RAW_COLUMNS} FROM raw",
    "raw_distinct": f"""WITH {O}
SELECT url AS property_url, CASE WHEN k % 2 = 1 THEN {N} END AS price_eur, CAST(NULL AS BIGINT) AS garden_m2 FROM o""",
    "ragged_records": f"""WITH {O}
SELECT CASE WHEN k % 19 <> 0 THEN url END AS property_url,
  CASE WHEN k % 19 <> 0 AND k % 5 IN (1, 2, 4) THEN CAST(floor(total) AS BIGINT) END AS price_eur,
  CASE WHEN k % 19 <> 0 AND k % 4 < 2 THEN k % 7 END AS bedrooms,
  CASE WHEN k % 19 = 0 THEN NULL WHEN k % 3 = 0 THEN 'Gas' WHEN k % 3 = 1 THEN CAST(k % 9 AS VARCHAR) END AS heating_type,
  CAST(NULL AS BIGINT) AS garden_m2 FROM o""",
    "collapse_text": f"""WITH t AS (SELECT doc_id, {squeezed("text")} AS t FROM documents)
SELECT doc_id, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS n_chars FROM t""",
    "parse_price": scalar(f"CASE k % 6 WHEN 2 THEN NULL WHEN 4 THEN {N} % 1000 WHEN 5 THEN NULL ELSE {N} END", "price_eur"),
    "parse_area": scalar(f"CASE k % 4 WHEN 2 THEN 5 WHEN 3 THEN NULL ELSE {AREA} END", "area_m2"),
    "parse_epc": scalar("CASE k % 3 WHEN 1 THEN NULL ELSE k % 600 END", "energy_kwh"),
    "parse_int": scalar("CASE k % 3 WHEN 1 THEN NULL ELSE k * 7 + 1 END", "first_int"),
    "yes_no_lenient": scalar("['Yes','No',NULL,'Yes','No',NULL,NULL][k % 7 + 1]", "flag"),
    "split_locality": scalar(
        "CASE WHEN k % 6 IN (0, 5) THEN postal END",
        "postal_code",
        """, CASE k % 6 WHEN 2 THEN NULL WHEN 3 THEN '1 Foo' WHEN 5 THEN '9' ELSE 'Town' || (k % 100) END AS locality_name""",
    ),
    "looks_locality": scalar("k % 6 = 0", "is_locality"),
    "norm_label": scalar(
        "CASE k % 6 WHEN 0 THEN 'cadastral income (not indexed)' WHEN 1 THEN 'surface garden m2' "
        "WHEN 2 THEN 'epc / peb' WHEN 4 THEN 'type-' || k ELSE '' END",
        "label",
    ),
    "label_field": scalar("CASE k % 6 WHEN 0 THEN 'cadastral_income_eur' END", "field"),
    "type_from_url": scalar(
        "CASE k % 4 WHEN 0 THEN ['apartment','house','house','studio','house','loft','duplex','penthouse'][k % 8 + 1] "
        "WHEN 2 THEN 'sale' END",
        "property_type",
    ),
    "null_tokens": scalar(
        "CASE k % 8 WHEN 0 THEN 'fine ' || k WHEN 2 THEN 'm2' WHEN 5 THEN 'None of these' WHEN 6 THEN '12' END", "v"
    ),
    "to_numeric": scalar(
        "CASE k % 7 WHEN 0 THEN k % 1000 + 0.5::DOUBLE WHEN 1 THEN CAST('1.' || (k % 1000) AS DOUBLE) "
        "WHEN 4 THEN CAST((k % 1000) * -10 AS DOUBLE) WHEN 5 THEN CAST(k % 1000 AS DOUBLE) "
        "WHEN 6 THEN CAST((k % 1000) || '3' AS DOUBLE) END",
        "number",
    ),
    "yes_no_strict": scalar("['yes',NULL,'no','yes','no',NULL][k % 6 + 1]", "flag"),
    "postal_extract": scalar("CASE WHEN k % 4 < 3 THEN postal END", "postal_code"),
    "province_case": scalar(province("CASE WHEN k % 29 <> 0 THEN postal END"), "province"),
    "province_join": scalar(province("CASE WHEN k % 29 <> 0 THEN postal END"), "province"),
    "type_synonyms": scalar("['house','house','house','house','loft',NULL][k % 6 + 1]", "property_type"),
    "io_roundtrip": f"{DIRTY_SILVER} SELECT * FROM silver",
    "csv_roundtrip": f"WITH {RAW} SELECT {RAW_COLUMNS} FROM raw",
    "silver_csv": f"{DIRTY_SILVER} SELECT * FROM silver",
    "stream_available_now": f"""WITH {recrawled(RAW)}, gone AS (SELECT url AS property_url FROM o WHERE k % 7 = 0)
SELECT {RAW_COLUMNS} FROM raw WHERE k % 7 > 0 UNION ALL BY NAME SELECT property_url FROM gone""",
    "stream_best": f"WITH {recrawled(PAGE_ROWS).replace('FROM raw WHERE', 'FROM raw WHERE k % 7 > 0 AND')}, {BEST} SELECT * FROM silver",
}
ORACLES["url_list_roundtrip"] = ORACLES["collect_urls"].replace(
    "SELECT url, min(page_id) AS first_page, CAST(arg_min(pos, page_id) AS INTEGER) AS first_pos FROM placed GROUP BY url",
    "SELECT DISTINCT url FROM placed",
)
