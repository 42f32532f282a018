"""Records as JSON texts whose keys and types differ from one to the next, read as Spark's VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brickrow import schemas

#: A key as a path of a variant; the keys of records are not nested.
_PATH = "$['{}']"


def as_variant(texts: DataFrame, column: str) -> DataFrame:
    """The column as VARIANT, parsed once; a text that is no JSON is null."""
    return texts.withColumn(column, F.try_parse_json(column))


def key_schema(variants: DataFrame, column: str) -> str:
    """The schema that all records together have, as text: types are widened until they fit all."""
    return variants.agg(F.schema_of_variant_agg(column).alias("found")).first().found


def value(record: Column, name: str, kind: T.DataType) -> Column:
    """One key of a record in the wanted type; absent, null, nested or unreadable ones are null.

    A whole number may be written as a text and may have a fraction, which is cut off.
    """
    path = _PATH.format(name)
    if kind != T.LongType():
        nested = F.schema_of_variant(F.try_variant_get(record, path, "variant")).rlike("^(OBJECT|ARRAY)<")
        return F.when(~nested, F.try_variant_get(record, path, kind.simpleString()))
    number = F.try_variant_get(record, path, "double").try_cast("bigint")
    return F.coalesce(F.try_variant_get(record, path, "string").try_cast("bigint"), number)


def to_raw(variants: DataFrame, column: str) -> DataFrame:
    """The RAW columns of the records; further keys are dropped. A null record is a row of nulls."""
    record = F.col(column)
    return variants.select(*[value(record, f.name, f.dataType).alias(f.name) for f in schemas.RAW])
