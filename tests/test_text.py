"""Literal rows for every scalar function."""

import pytest

from brickrow.functions import fields, places, text
from brickrow.lookups import PROVINCE_RANGES
from brickrow.operators import clean, ranges

THIN = "\N{NARROW NO-BREAK SPACE}"
HARD = "\N{NO-BREAK SPACE}"

CASES = {
    "collapse": (text.collapse, [(" a \t\n b ", "a b"), (f"{HARD}x{THIN}{THIN}y\x1f", "x y"), (" ", None), ("", None), (None, None)]),
    "first_int": (text.first_int, [("1 234", 1), (f"12{THIN}5", 12), ("abc", None), ("a007b", 7), ("", None), (None, None), ("9" * 30, None)]),
    "price": (
        text.price_eur,
        [
            ("250 000 €", 250000),
            (f"250{THIN}000{HARD}€", 250000),
            ("1.250.000 €", 1250000),
            ("1,250 €", 250),
            ("€ 100", None),
            ("from 5 to 10 €", 10),
            ("0 €", 0),
            ("  ", None),
            (None, None),
        ],
    ),
    "area": (text.area_m2, [("85 m²", 85), ("1 200 m²", 200), ("12,5 m²", 5), (f"40{HARD}m²", 40), ("40m2", None), (None, None)]),
    "energy": (text.energy_kwh, [("123 kWh/m²/year", 123), ("123 kwh/m²/year", None), ("7kWh/m²/year!", 7), ("B", None)]),
    "yes_no_lenient": (
        text.yes_no_lenient,
        [("Yes, heated", "Yes"), ("unknown", "No"), ("Not specified", "No"), ("none", "No"), ("maybe", None), (" Y ", "Yes"), ("TRUE", "Yes"), ("n", "No"), ("false", "No"), ("truey", None), ("", None), (None, None)],
    ),
    "postal": (text.locality_postal, [("1000 Brussels", "1000"), ("1000-Brussels", None), ("1000", None), ("10001 Foo", None), (f" 1000{HARD}X", "1000"), (None, None)]),
    "locality": (
        text.locality_name,
        [("1000 Brussels", "Brussels"), ("1000-Brussels", "Brussels"), ("1000 – Brussels", "– Brussels"), ("1000", None), ("10001 Foo", "1 Foo"), ("Gent  Zuid", "Gent Zuid"), ("", None)],
    ),
    "looks_like_locality": (text.looks_like_locality, [("1000 Brussels", True), (" 1000 Xy", True), ("1000 X", False), ("1000-Xy", False), ("Good", False)]),
    "norm_label": (
        text.norm_label,
        [("Cadastral Income (not indexed):", "cadastral income (not indexed)"), ("Surface  m²", "surface m2"), ("A * B", "a b"), ("a-b/c_d", "a-b/c_d"), (":", ""), (None, "")],
    ),
    "label_field": (
        places.field_of_label,
        [("Habitable surface:", "livable_surface_m2"), ("PEB", "epc_kwh_m2_year"), ("Cadastral estimate", "cadastral_income_eur"), ("Garage", None), (None, None)],
    ),
    "type_from_url": (
        places.type_from_url,
        [("/en/detail/villa/x", "house"), ("/en/detail/villa", None), ("/en/detail/sale/house/1", "sale"), ("/en/detail/Flat-Studio/1", "studio"), ("/en/detail/Penthouse/1", "penthouse"), ("/fr/x/", None)],
    ),
    "canonical_type": (places.canonical_type, [("Villa", "house"), (" MASTER ", "house"), ("master-house", "house"), ("Residence", "house"), ("Loft", "loft"), (None, None)]),
    "nfkc": (text.nfkc, [("\N{LATIN SMALL LIGATURE FI}ne", "fine"), ("m²", "m2"), ("Lie\N{COMBINING GRAVE ACCENT}ge", "Li\N{LATIN SMALL LETTER E WITH GRAVE}ge"), ("plain", "plain"), (None, None)]),
    "blank_tokens": (
        text.blank_tokens,
        [(" N/A ", None), ("--", None), ("-", None), ("Not  Specified", None), ("unknown", None), ("NaN", None), ("null", None), ("None", None), ("na", None), ("", None), ("nano", "nano"), (" a  b ", "a b")],
    ),
    "to_number": (
        text.to_number,
        [("1,5", 1.5), ("1.250 €", 1.25), ("1.234.567", None), ("-", None), ("", None), ("5.", 5.0), ("-.5", -0.5), ("5-", None), (f"1{THIN}250{HARD}000", 1250000.0), ("1e3", 13.0), ("Infinity", None), ("3d", 3.0), (None, None)],
    ),
    "yes_no_strict": (text.yes_no_strict, [("TRUE", "yes"), ("unknown", None), ("0", "no"), ("1", "yes"), ("Y", "yes"), ("n", "no"), ("no", "no"), ("yes!", None), (None, None)]),
    "postal_digits": (text.postal_digits, [("B-1000", "1000"), ("12345", "1234"), ("999", None), ("0123", "0123"), (None, None)]),
    "cadastral": (
        text.cadastral_eur,
        [
            ("x Cadastral income (not indexed) 1 877 € y", 1877),
            ("CADASTRAL REVENUE: 1.200 €", 1200),
            ("cadastral 5 €", None),
            ("cadastral income " + "x" * 41 + "5 €", None),
            ("cadastral income none. cadastral income 7 €", 7),
            ("cadastral income 12,5 €", None),
        ],
    ),
    "read_cadastral": (fields.read_cadastral, [("0 € for 5", 0), ("877", 877), ("1 877 €", 1877), ("none", None)]),
}


@pytest.mark.parametrize("name", CASES)
def test_scalar(evaluate, name):
    fn, rows = CASES[name]
    assert evaluate(fn, [r[0] for r in rows]) == [r[1] for r in rows]


def test_valid_values(spark):
    rows = [
        ("bedrooms", "3 rooms", True),
        ("bedrooms", "on request", False),
        ("terrace_m2", "12", False),
        ("terrace_m2", "12 m²", True),
        ("epc_kwh_m2_year", "B", False),
        ("swimming_pool", "maybe", False),
        ("currently_leased", "unknown", True),
        ("state_of_the_property", "1000 Brussels", False),
        ("state_of_the_property", "x" * 60, True),
        ("state_of_the_property", "x" * 61, False),
        ("heating_type", "90", False),
        ("heating_type", "90 m2", False),
        ("heating_type", "Gas", True),
        ("heating_type", "g" * 61, False),
        ("cadastral_income_eur", "877", True),
        ("cadastral_income_eur", "none", False),
        ("other", "x", True),
        ("other", "", False),
        ("other", None, False),
    ]
    table = spark.createDataFrame(rows, "f string, v string, expected boolean")
    got = table.select("f", "v", "expected", fields.is_valid(table.f, table.v).alias("got")).collect()
    assert [r for r in got if r.got != r.expected] == []


def test_province_at_both_ends_of_every_range(spark):
    rows = [(f"{z:04d}", name) for low, high, name in PROVINCE_RANGES for z in (low, high)]
    rows += [("0999", "Outside Belgium / Invalid"), (None, "Unknown"), ("x", "Unknown"), (" 1000 ", "Brussels")]
    table = spark.createDataFrame(rows, "postal_code string, expected string")
    by_case = table.select(places.province(table.postal_code).alias("got"), "expected").collect()
    by_join = ranges.province_by_join(table).select("province", "expected").collect()
    assert all(r.got == r.expected for r in by_case)
    assert len(by_join) == len(rows) and all(r.province == r.expected for r in by_join)


def test_null_words_touch_only_the_named_columns(spark):
    table = spark.createDataFrame([("\N{FULLWIDTH DIGIT ONE}", " n/a ", "-")], "a string, b string, c string")
    assert clean.null_words(table, ["a", "b"]).first() == ("1", None, "-")
