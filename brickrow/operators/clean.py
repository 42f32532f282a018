"""RAW to SILVER: normalise, filter, keep the best record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickrow import lookups, schemas
from brickrow.functions import places, text
from brickrow.operators.distinct import first_row

KEPT = [f.name for f in schemas.SILVER if f.name != "province"]


def null_words(table: DataFrame, columns: list[str]) -> DataFrame:
    """NFKC and single spaces in the given columns; the words that stand for "missing" are null."""
    wide = _to_nfkc(table, columns)
    return wide.select(*[text.blank_tokens(F.col(c)).alias(c) if c in columns else c for c in wide.columns])


def _to_nfkc(table: DataFrame, columns: list[str]) -> DataFrame:
    # A step of its own, so that all columns go to the Python worker together and once.
    return table.select(*[text.nfkc(F.col(c)).alias(c) if c in columns else c for c in table.columns])


def normalize_rows(raw: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Kept columns with null words, types, postal codes, flags and numbers normalised, and the
    province added. Numbers stay fractional. Needs ``price_eur``; other columns may be absent.

    Columns in ``also`` go along unchanged."""
    types = dict(raw.dtypes)
    kept = [c for c in KEPT if c in types]
    wide = _to_nfkc(raw.select(*kept, *also), [c for c in kept if types[c] == "string"])
    if "postal_code" not in types:
        wide = wide.withColumn("postal_code", F.lit(None).cast("string"))
    worded = [c for c in wide.columns if c not in schemas.NUMERIC and c not in also]
    named = wide.select(*[text.blank_tokens(F.col(c)).alias(c) if c in worded else c for c in wide.columns])

    def read(c: str) -> Column:
        col = F.col(c)
        if c in also:
            return col
        if c in schemas.NUMERIC:
            # The null words are no numbers, so they need no step of their own.
            return text.to_number(col) if types[c] == "string" else col.cast("double")
        if c in schemas.FLAGS:
            return text.yes_no_strict(col)
        if c == "property_type":
            return places.canonical_type(col)
        if c == "postal_code":
            return text.postal_digits(col)
        return col

    return named.select(*[read(c).alias(c) for c in named.columns]).withColumn(
        "province", places.province(F.col("postal_code"))
    )


def filter_prices(rows: DataFrame, low: int = lookups.MIN_PRICE, high: int = lookups.MAX_PRICE) -> DataFrame:
    """Drop records without a price, below the floor or above the cap."""
    return rows.where(F.col("price_eur").between(low, high))


def blank_years(rows: DataFrame, low: int = lookups.MIN_BUILD_YEAR, high: int = lookups.MAX_BUILD_YEAR) -> DataFrame:
    """Build years out of range become null, the record stays."""
    if "build_year" not in rows.columns:
        return rows
    year = F.col("build_year")
    return rows.withColumn("build_year", F.when(year.between(low, high), year))


def _price_order(rows: DataFrame) -> list[Column]:
    """Dearest first, then by URL; the other columns only settle full ties."""
    ties = ["property_url", *[c for c in rows.columns if c not in ("property_url", "price_eur")]]
    return [F.desc("price_eur"), *[F.asc_nulls_last(c) for c in ties if c in rows.columns]]


def best_per_code(rows: DataFrame, keep_null_codes: bool = False) -> DataFrame:
    """The dearest record of every ``property_code``.

    Records without a code count as one code; ``keep_null_codes`` keeps one per URL instead.
    """
    if "property_code" not in rows.columns:
        return rows
    keys: list = ["property_code"]
    if keep_null_codes:
        keys.append(F.when(F.col("property_code").isNull(), F.col("property_url")))
    return first_row(rows, keys, _price_order(rows))


def best_per_url(rows: DataFrame) -> DataFrame:
    if "property_url" not in rows.columns:
        return rows
    return first_row(rows, ["property_url"], _price_order(rows))


def whole_numbers(rows: DataFrame) -> DataFrame:
    """Numeric columns as integers, fractions cut off, null beyond 64 bits; SILVER column order."""
    return rows.select(
        *[
            F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in schemas.SILVER
            if f.name in rows.columns
        ]
    )


def clean_rows(raw: DataFrame, max_build_year: int = lookups.MAX_BUILD_YEAR, also: Sequence[str] = ()) -> DataFrame:
    """Everything that looks at one record at a time; columns in ``also`` go along unchanged."""
    return blank_years(filter_prices(normalize_rows(raw, also)), high=max_build_year)


def silver(raw: DataFrame, keep_null_codes: bool = False, max_build_year: int = lookups.MAX_BUILD_YEAR) -> DataFrame:
    """RAW records, typed or as text, to SILVER.

    The filters come before the choice of the best record, so a code whose dearest record is over
    the cap keeps its next dearest.
    """
    rows = clean_rows(raw, max_build_year)
    return whole_numbers(best_per_url(best_per_code(rows, keep_null_codes)))


def dearest_first(silver_table: DataFrame) -> DataFrame:
    return silver_table.orderBy(F.desc("price_eur"), F.asc_nulls_last("property_url"))


def head(silver_table: DataFrame, n: int = 5) -> DataFrame:
    return dearest_first(silver_table).limit(n)
