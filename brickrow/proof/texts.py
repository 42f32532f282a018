"""Value texts made from ``orders``, one row per order, for the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickrow.proof.render import HARD, NARROW, SITE, cat, keyed, num, pick, postal, slug


def texts(orders: DataFrame, **columns) -> DataFrame:
    return keyed(orders).select("k", *[c.alias(name) for name, c in columns.items()])


def price():
    n = F.floor("total")
    commas = F.format_number(n, 0)
    return pick(
        6,
        cat(F.translate(commas, ",", " "), " €"),
        cat(F.translate(commas, ",", "."), "€"),
        cat("€ ", n.cast("string")),
        cat("Asking price: ", F.translate(commas, ",", NARROW), HARD, "€ or more"),
        cat(commas, " €"),
        "on request",
    )


def area():
    a = num("30 + cu % 400")
    return pick(4, cat(a, " m²"), cat("about 1 ", a, "m²"), cat(a, ",5", HARD, "m²"), cat(a, " m2"))


def energy():
    e = num("k % 600")
    return pick(3, cat(e, " kWh/m²/year"), cat(e, " kwh/m²/year"), cat("EPC ", e, HARD, "kWh/m²/year (B)"))


def number():
    x = num("k * 7 + 1")
    return pick(3, cat("n:", x, " y 7"), "none", cat(x, NARROW, "000"))


def answer():
    return pick(7, "Yes, heated", "unknown", "maybe", " Y ", "FALSE", "", None)


def place():
    town = cat("Town", num("k % 100"))
    return pick(
        6, cat(postal(), "  ", town), cat(postal(), "-", town), postal(), cat(postal(), "1 Foo"), cat(" ", town, HARD), cat(postal(), " 9")
    )


def label():
    return pick(
        6, " Cadastral  Income (not indexed): ", "Surface, garden m²!", "EPC / PEB?", None, cat("Type-", num("k")), ":"
    )


def listing_link():
    return pick(
        4, cat(SITE, "/en/detail/", slug(), "/for-sale/", num("k")), cat(SITE, "/en/detail/", slug()), cat(SITE, "/en/detail/sale/house/", num("k")), cat(SITE, "/fr/detail/villa/", num("k"))
    )


def untidy():
    return pick(
        8, cat("\N{LATIN SMALL LIGATURE FI}ne  ", num("k")), " N/A ", "m²", "Not\tSpecified", cat(HARD, "--", HARD), "None of these", "\N{FULLWIDTH DIGIT ONE}\N{FULLWIDTH DIGIT TWO}", ""
    )


def untidy_number():
    n = num("k % 1000")
    return pick(
        7, cat(n, ",5"), cat("1.", n, " €"), "1.234.567", "-", cat(" -", n, NARROW, "0 "), cat(n, "."), cat("EUR ", n, "e3")
    )


def untidy_flag():
    return pick(6, "TRUE", "unknown", "0", " y ", "No", "yes please")


def untidy_postal():
    return pick(4, cat("B-", postal()), cat(postal(), "5"), cat("12 ", postal()), "B 123")


def type_name():
    return pick(6, "Residence", " VILLA ", "master", "Master-House", "Loft", None)
