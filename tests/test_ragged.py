"""Records whose keys and types differ."""

from brickrow import schemas
from brickrow.operators import ragged

TEXTS = [
    '{"property_url": "u1", "price_eur": 300000, "bedrooms": 2, "heating_type": "Gas"}',
    '{"property_url": "u2", "price_eur": "250000", "bedrooms": "2.9", "garden_m2": 1.9, "agent": {"name": "x"}}',
    '{"property_url": "u3", "price_eur": {"amount": 1}, "bedrooms": "two", "heating_type": ["a", "b"], "toilets": true}',
    '{"property_url": 4, "price_eur": null, "heating_type": 7, "bedrooms": 99999999999999999999}',
    '["u5"]',
    "{}",
    "no json",
    "",
    None,
]


def raw(spark, texts):
    table = spark.createDataFrame([(t,) for t in texts], "record string")
    return ragged.to_raw(ragged.as_variant(table, "record"), "record")


def test_records_become_raw(spark):
    found = raw(spark, TEXTS)
    assert found.schema == schemas.RAW
    rows = [(r.property_url, r.price_eur, r.bedrooms, r.heating_type, r.garden_m2) for r in found.collect()]
    assert rows[:4] == [
        ("u1", 300000, 2, "Gas", None),
        ("u2", 250000, 2, None, 1),
        ("u3", None, None, None, None),
        ("4", None, None, "7", None),
    ]
    assert rows[4:] == [(None,) * 5] * 5


def test_the_schema_of_all_records(spark):
    table = spark.createDataFrame([(t,) for t in TEXTS[:2]], "record string")
    found = ragged.key_schema(ragged.as_variant(table, "record"), "record")
    assert found.startswith("OBJECT<") and "agent: OBJECT<name: STRING>" in found and "price_eur: VARIANT" in found


def test_no_records(spark):
    assert raw(spark, []).collect() == []
