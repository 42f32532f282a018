import random

import pandas as pd
import pytest

from brickrow import schemas
from brickrow.operators import clean, listing, quality
from brickrow.proof import render


def raw(spark, *rows):
    """RAW from partial records."""
    named = [{f.name: r.get(f.name) for f in schemas.RAW} for r in rows]
    return spark.createDataFrame([tuple(r.values()) for r in named], schemas.RAW)


def listed(table, *columns):
    return sorted((tuple(r) for r in table.select(*columns).collect()), key=repr)


def test_price_limits(spark):
    prices = [None, 9999, 10000, 7500000, 7500001]
    table = raw(spark, *[{"property_url": str(i), "property_code": str(i), "price_eur": p} for i, p in enumerate(prices)])
    assert [p for (p,) in listed(clean.silver(table), "price_eur")] == [10000, 7500000]


def test_price_limits_see_the_fraction(spark):
    rows = [("a", "a", "9999,99"), ("b", "b", "7500000.5"), ("c", "c", "10000.9")]
    table = spark.createDataFrame(rows, "property_url string, property_code string, price_eur string")
    assert listed(clean.silver(table), "property_url", "price_eur") == [("c", 10000)]


def test_build_years(spark):
    years = [1799, 1800, 2026, 2027, None]
    table = raw(spark, *[{"property_url": str(i), "property_code": str(i), "price_eur": 20000, "build_year": y} for i, y in enumerate(years)])
    assert [y for _, y in listed(clean.silver(table), "property_url", "build_year")] == [None, 1800, 2026, None, None]
    later = clean.silver(table, max_build_year=2030)
    assert [y for _, y in listed(later, "property_url", "build_year")] == [None, 1800, 2026, 2027, None]


def test_best_record_per_code_then_per_url(spark):
    table = raw(
        spark,
        {"property_code": "A", "property_url": "u1", "price_eur": 20000},
        {"property_code": "A", "property_url": "u2", "price_eur": 30000},
        {"property_code": "A", "property_url": "u0", "price_eur": 30000},  # tie: by URL
        {"property_code": "B", "property_url": "u0", "price_eur": 25000},  # loses u0 to A
        {"property_code": "C", "property_url": "u3", "price_eur": 9000000},  # over the cap
        {"property_code": "C", "property_url": "u4", "price_eur": 50000},
    )
    assert listed(clean.silver(table), "property_code", "property_url") == [("A", "u0"), ("C", "u4")]


def test_choice_agrees_with_brute_force_under_a_hot_key(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(3000):
        hot = rng.random() < 0.34
        code = "HOT" if hot else rng.choice([None, *(f"C{i}" for i in range(400))])
        url = "hot" if rng.random() < 0.34 else f"u{rng.randrange(500)}"
        rows.append((code, url, 20000 + rng.randrange(300)))
    frame = pd.DataFrame(rows, columns=["code", "url", "price"])
    ordered = frame.sort_values(["price", "url", "code"], ascending=[False, True, True], na_position="last")
    best = ordered.drop_duplicates("code").drop_duplicates("url")
    expected = sorted(((None if pd.isna(c) else c, u, p) for c, u, p in best.itertuples(index=False)), key=repr)
    table = spark.createDataFrame(rows, "property_code string, property_url string, price_eur bigint").repartition(6)
    assert listed(clean.silver(table), "property_code", "property_url", "price_eur") == expected


def test_missing_codes_are_one_code(spark):
    rows = [{"property_url": f"u{i}", "price_eur": 20000 + i} for i in range(4)]
    rows.append({"property_url": "u3", "property_code": "n/a", "price_eur": 20009})
    table = raw(spark, *rows)
    assert listed(clean.silver(table), "property_url", "price_eur") == [("u3", 20009)]
    kept = clean.silver(table, keep_null_codes=True)
    assert listed(kept, "property_url", "price_eur") == [("u0", 20000), ("u1", 20001), ("u2", 20002), ("u3", 20009)]


def test_columns(spark):
    table = raw(spark, {"property_url": "u", "property_code": "1", "price_eur": 20000, "heating_type": "Gas"})
    assert clean.silver(table).schema.names == schemas.SILVER.names
    assert [f.dataType for f in clean.silver(table).schema] == [f.dataType for f in schemas.SILVER]
    small = spark.createDataFrame([(20000, "x")], "price_eur bigint, extra string")
    assert clean.silver(small).columns == ["price_eur", "postal_code", "province"]
    assert clean.silver(small).first().province == "Unknown"


def test_without_codes_only_urls_are_made_unique(spark):
    table = spark.createDataFrame([("u", 20000), ("u", 30000), ("v", 20000)], "property_url string, price_eur bigint")
    assert listed(clean.silver(table), "property_url", "price_eur") == [("u", 30000), ("v", 20000)]


def test_cleaning_again_changes_nothing_and_partitions_do_not_matter(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    dirty = render.dirty_raw(orders)
    once = clean.silver(dirty)
    names = schemas.SILVER.names
    expected = listed(once, *names)
    assert listed(clean.silver(dirty.repartition(1)), *names) == expected
    assert listed(clean.silver(dirty.repartition(7)), *names) == expected
    assert listed(clean.silver(listing.to_raw(once)), *names) == expected
    codes = [r[1] for r in expected]
    urls = [r[0] for r in expected]
    assert len(set(codes)) == len(codes) and len(set(urls)) == len(urls)
    assert all(10000 <= r[3] <= 7500000 for r in expected)


def test_head_is_in_price_order(spark):
    rows = [{"property_url": f"u{i}", "property_code": str(i), "price_eur": 20000 + i % 3} for i in range(9)]
    got = clean.head(clean.silver(raw(spark, *rows)), 4).collect()
    assert [(r.price_eur, r.property_url) for r in got] == [(20002, "u2"), (20002, "u5"), (20002, "u8"), (20001, "u1")]


def test_gate(spark):
    good = clean.silver(raw(spark, {"property_url": "u", "property_code": "1", "price_eur": 20000, "postal_code": "0999"}))
    assert tuple(quality.check(good)) == (1, 0, 1)
    assert quality.shape(good) == (1, 20)
    with pytest.raises(quality.QualityGateError, match="empty"):
        quality.check(good.limit(0))
    with pytest.raises(quality.QualityGateError, match="price"):
        quality.check(spark.createDataFrame([(None, "x")], "price_eur bigint, province string"))


def test_profile(spark):
    table = spark.createDataFrame([(1, None), (2, "x")], "a bigint, b string")
    got = [tuple(r) for r in quality.profile(table).orderBy("position").collect()]
    assert got == [(0, "a", "bigint", 2), (1, "b", "string", 1)]
