"""What a labelled value must look like, and how it is read. Values are collapsed text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from brickrow import lookups
from brickrow.functions import text


def read_cadastral(value: Column) -> Column:
    """A price other than zero, else the first number."""
    return F.coalesce(F.nullif(text.price_eur(value), F.lit(0)), text.first_int(value))


def _short(value: Column) -> Column:
    return F.char_length(value) <= lookups.MAX_TEXT_VALUE


def _worded(value: Column) -> Column:
    return value.rlike("[A-Za-z]") & ~F.lower(value).rlike(r"^[0-9]+ *(m2|m²)?$")


def _as_it_is(value: Column) -> Column:
    return value


#: Fields, how their values are read, and what else a value must be besides readable.
RULES: list[tuple[list[str], Callable[[Column], Column], Callable[[Column], Column] | None]] = [
    (lookups.COUNT_FIELDS, text.first_int, None),
    (lookups.AREA_FIELDS, text.area_m2, None),
    ([lookups.ENERGY_FIELD], text.energy_kwh, None),
    (lookups.FLAG_FIELDS, text.yes_no_lenient, None),
    ([lookups.CADASTRAL_FIELD], read_cadastral, None),
    ([lookups.STATE_FIELD], _as_it_is, lambda v: _short(v) & ~text.looks_like_locality(v)),
    ([lookups.HEATING_FIELD], _as_it_is, lambda v: _short(v) & _worded(v)),
]
READERS = {field: read for names, read, _ in RULES for field in names}


def read_field(field: str, value: Column) -> Column:
    """The typed value of one field."""
    return READERS.get(field, _as_it_is)(value)


def is_valid(field: Column, value: Column) -> Column:
    """Whether ``value`` is acceptable for the field named in ``field``."""
    rule = F.when(F.coalesce(value, F.lit("")) == "", False)
    for names, read, also in RULES:
        rule = rule.when(field.isin(names), also(value) if also else read(value).isNotNull())
    return rule.otherwise(True)
