"""Look-ups: property type, labelled field, province."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from brickrow import lookups
from brickrow.functions.text import norm_label, strip


def literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def type_from_url(url: Column) -> Column:
    """Property type from the path segment after ``/en/detail/``; unknown types are kept."""
    raw = F.lower(strip(F.regexp_extract(url, "/en/detail/([^/]+)/", 1)))
    return F.coalesce(literal_map(lookups.URL_TYPES)[raw], F.nullif(raw, F.lit("")))


def canonical_type(c: Column) -> Column:
    """Lower case; the names for a house become ``house``."""
    v = F.lower(F.trim(c))
    return F.when(v.isin(lookups.HOUSE_SYNONYMS), "house").otherwise(v)


def field_of_label(label: Column) -> Column:
    """Field that a heading names; any other heading about cadastral income counts as that."""
    fields = literal_map(lookups.LABEL_FIELDS)

    def named(plain: Column) -> Column:
        return F.coalesce(fields[plain], F.when(plain.contains(lookups.CADASTRAL_WORD), lookups.CADASTRAL_FIELD))

    # Most labels are in normal form but for their case; the others are normalised once.
    other = F.get(F.transform(F.array(norm_label(label)), named), F.lit(0))
    return F.coalesce(fields[F.lower(label)], other)


def province(postal: Column) -> Column:
    """Province of a postal code; not a number is ``Unknown``, outside all ranges invalid."""
    z = F.trim(postal).try_cast("int")
    found = F.when(z.isNull(), lookups.PROVINCE_UNKNOWN)
    for low, high, name in lookups.PROVINCE_RANGES:
        found = found.when(z.between(low, high), name)
    return found.otherwise(lookups.PROVINCE_INVALID)
