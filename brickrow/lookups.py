"""Word lists, look-up tables and constants that define the results."""

# --- Fixed values: frontier ---------------------------------------------------------------

PROVINCE_SLUGS = [
    "antwerp",
    "vlaams-brabant",
    "brabant-wallon",
    "east-flanders",
    "west-flanders",
    "hainaut",
    "brussels",
    "liege",
    "limburg",
    "namur",
    "luxembourg",
]

SLUG_OF = {
    "Antwerp": "antwerp",
    "Flemish Brabant": "vlaams-brabant",
    "Walloon Brabant": "brabant-wallon",
    "East Flanders": "east-flanders",
    "West Flanders": "west-flanders",
    "Hainaut": "hainaut",
    "Brussels": "brussels",
    "Liège": "liege",
    "Limburg": "limburg",
    "Namur": "namur",
    "Luxembourg": "luxembourg",
}

SEARCH_QUERY = (
    "/en/real-estate?transactiontypes=for-sale,in-public-sale&propertytypes=house,apartment"
    "&provinces={province}&islifeannuity=no&page={page}&noindex=1"
)

DETAIL_MARK = "/en/detail/"
SALE_DETAIL_MARK = "/en/detail/sale/"
STAGING_PATTERN = "(?i)/sale/|projectdetail"
CARD_CLASS = "card-title ellipsis pr-2 mt-1 mb-0"

# --- Fixed values: listing page -----------------------------------------------------------

CODE_CLASS = "vlancode"
PRICE_CLASS = "detail__header_price_data"
LOCALITY_CLASS = "city-line"
MORE_INFORMATION = "more information"
FAILED_STATUS = 400  # of an HTTP answer, from here on

URL_TYPES = {
    "apartment": "apartment",
    "studio": "studio",
    "flat-studio": "studio",
    "loft": "loft",
    "house": "house",
    "residence": "house",
    "villa": "house",
    "master-house": "house",
    "bungalow": "bungalow",
    "mixed-building": "mixed-building",
    "duplex": "duplex",
}

LABEL_FIELDS = {
    "state of the property": "state_of_the_property",
    "condition": "state_of_the_property",
    "currently leased": "currently_leased",
    "build year": "build_year",
    "year of construction": "build_year",
    "number of bedrooms": "bedrooms",
    "number of bathrooms": "bathrooms",
    "number of toilets": "toilets",
    "livable surface": "livable_surface_m2",
    "living area": "livable_surface_m2",
    "habitable surface": "livable_surface_m2",
    "total land surface": "total_land_surface_m2",
    "surface terrace": "terrace_m2",
    "surface garden": "garden_m2",
    "type of heating": "heating_type",
    "specific primary energy consumption": "epc_kwh_m2_year",
    "epc": "epc_kwh_m2_year",
    "peb": "epc_kwh_m2_year",
    "swimming pool": "swimming_pool",
    "cadastral income": "cadastral_income_eur",
    "cadastral revenue": "cadastral_income_eur",
    "cadastral income (not indexed)": "cadastral_income_eur",
    "cadastral income (non-indexed)": "cadastral_income_eur",
}

CADASTRAL_WORD = "cadastral"
MAX_TEXT_VALUE = 60

# Which parser reads which labelled field.
COUNT_FIELDS = ["bedrooms", "bathrooms", "toilets", "build_year"]
AREA_FIELDS = ["livable_surface_m2", "total_land_surface_m2", "terrace_m2", "garden_m2"]
ENERGY_FIELD = "epc_kwh_m2_year"
FLAG_FIELDS = ["currently_leased", "swimming_pool"]
STATE_FIELD = "state_of_the_property"
HEATING_FIELD = "heating_type"
CADASTRAL_FIELD = "cadastral_income_eur"

# HTML elements that never have content.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)

# HTML elements whose text does not count as text of the elements around them.
ASIDE_TAGS = frozenset("rp rt script style template".split())

# --- Fixed values: cleaning ---------------------------------------------------------------

NULL_TOKENS = ["", "nan", "none", "null", "na", "n/a", "-", "--", "not specified", "unknown"]

# Cell texts a CSV reader takes for missing.
CSV_NULLS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

YES_WORDS = ["1", "true", "yes", "y"]
NO_WORDS = ["0", "false", "no", "n"]

HOUSE_SYNONYMS = ["residence", "villa", "master", "master-house"]

PROVINCE_RANGES = [
    (1000, 1299, "Brussels"),
    (1300, 1499, "Walloon Brabant"),
    (1500, 1999, "Flemish Brabant"),
    (2000, 2999, "Antwerp"),
    (3000, 3499, "Flemish Brabant"),
    (3500, 3999, "Limburg"),
    (4000, 4999, "Liège"),
    (5000, 5999, "Namur"),
    (6000, 6599, "Hainaut"),
    (6600, 6999, "Luxembourg"),
    (7000, 7999, "Hainaut"),
    (8000, 8999, "West Flanders"),
    (9000, 9999, "East Flanders"),
]
PROVINCE_UNKNOWN = "Unknown"
PROVINCE_INVALID = "Outside Belgium / Invalid"

MIN_PRICE = 10_000
MAX_PRICE = 7_500_000
MIN_BUILD_YEAR = 1800
MAX_BUILD_YEAR = 2026
