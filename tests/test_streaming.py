import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brickrow import schemas
from brickrow.operators import clean, listing
from brickrow.proof import render
from brickrow.streaming import incremental
from brickrow.streaming.state import Best, Latest

SITE = "https://site.example/en/detail/loft/"


def rows(table):
    return sorted((tuple(r) for r in table.select(*sorted(table.columns)).collect()), key=repr)


def size(folder):
    """Bytes of all files below a folder."""
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)


@pytest.fixture
def run(spark, tmp_path):
    """``run(pages)`` lands pages and brings RAW and SILVER up to date; its folder is ``run.path``."""
    landing, path = str(tmp_path / "landing"), str(tmp_path / "kept")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")  # every partition of every step has a store of its own

    def once(pages, **options):
        if pages is not None:
            pages.coalesce(2).write.mode("append").parquet(landing)
        landed = incremental.landed_pages(spark, landing, files_per_run=options.pop("files_per_run", 1000))
        incremental.stream_records(landed, path).awaitTermination()
        incremental.stream_silver(spark, path, **options)

    once.path = path
    yield once
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_runs_end_like_one_batch(spark, run):
    """Also where a URL comes again: cheaper, failed, or with an older page that lands late."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").limit(300)
    first = render.listing_pages(orders).withColumn("status", F.lit(None).cast("int"))
    older = first.where("page_id % 4 = 1").withColumn("page_id", -F.col("page_id")).withColumn("html", F.lit("<p>soon</p>"))
    pages = None
    for part in (first, render.recrawled_pages(orders), older):
        run(part)
        pages = part if pages is None else pages.unionByName(part)
    batch = listing.to_raw(listing.scrape(pages.select("url").distinct(), pages))
    assert rows(incremental.current_raw(spark, run.path)) == rows(batch)
    assert rows(incremental.current_silver(spark, run.path)) == rows(clean.silver(batch))


def page(page_id, name, code, price, status=None):
    header = f'<b class="vlancode">{code}</b>' if code else ""
    html = f'{header}<i class="detail__header_price_data">{price} &euro;</i>'
    return (page_id, SITE + name, None if price is None else html, status)


#: Runs of pages, one list for each.
RUNS = [
    [page(1, "a", "X", 300_000), page(2, "b", "X", 200_000), page(3, "c", "Y", 100_000), page(4, "d", None, 50_000), page(5, "e", None, 60_000)],
    [page(6, "a", "X", 150_000)],  # the dearest falls: the next one comes back
    [page(7, "b", "X", None)],  # and fails: back to the first
    [page(8, "a", "Z", 150_000), page(9, "c", "X", 90_000)],  # codes change
    [page(10, "e", None, 9_000)],  # below the floor
    [page(11, "a", "Z", 9_000_000), page(12, "a", "X", 150_000), page(13, "f", "Y", 70_000)],  # twice in one run
    [page(14, "d", "Y", 500_000, 404), page(3, "c", "Y", 999_000)],  # an answer that failed, an old page
]


def test_silver_follows_falls_failures_and_moves(spark, run):
    pages = []
    for landed in RUNS:
        pages += landed
        run(spark.createDataFrame(landed, schemas.PAGES))
        whole = spark.createDataFrame(pages, schemas.PAGES)
        batch = listing.to_raw(listing.scrape(whole.select("url").distinct(), whole))
        assert rows(incremental.current_silver(spark, run.path)) == rows(clean.silver(batch))


@pytest.mark.parametrize("keep_null_codes", [False, True])
def test_all_runs_at_once_end_the_same(spark, run, keep_null_codes):
    """Several changes of one record reach a later step together."""
    for landed in RUNS:
        spark.createDataFrame(landed, schemas.PAGES).coalesce(1).write.mode("append").parquet(run.path.replace("kept", "landing"))
    run(None, files_per_run=1, keep_null_codes=keep_null_codes)
    pages = [p for landed in RUNS for p in landed]
    whole = spark.createDataFrame(pages, schemas.PAGES)
    batch = listing.to_raw(listing.scrape(whole.select("url").distinct(), whole))
    assert rows(incremental.current_silver(spark, run.path)) == rows(clean.silver(batch, keep_null_codes))


def test_a_small_run_writes_little_and_touches_its_codes_only(spark, run):
    names = [page(i, f"u{i}", f"C{i % 700}", 100_000 + i) for i in range(3000)]
    run(spark.createDataFrame(names, schemas.PAGES))
    changes = {name: spark.read.parquet(f"{run.path}/{name}").count() for name in ("changes", "part_changes", "code_changes", "silver_changes")}
    assert changes["changes"] == 3000 and changes["code_changes"] == 700
    before = size(run.path)
    run(spark.createDataFrame([page(9000, "u5", "C5", 900_000), page(9001, "u6", "C6", 20_000)], schemas.PAGES))
    after = {name: spark.read.parquet(f"{run.path}/{name}").count() for name in changes}
    assert after["changes"] - changes["changes"] == 2
    # The one that rose is its code's best now, the other was not and is not.
    codes = spark.read.parquet(f"{run.path}/code_changes").orderBy(F.desc("version")).limit(1).collect()
    assert after["code_changes"] - changes["code_changes"] == 1 and codes[0].code == "cC5"
    assert size(run.path) - before < before / 4
    run(None)  # nothing new
    assert {name: spark.read.parquet(f"{run.path}/{name}").count() for name in changes} == after


def test_nothing_landed_yet(spark, tmp_path):
    path = str(tmp_path / "none")
    incremental.stream_silver(spark, path)
    assert incremental.current_raw(spark, path).schema == schemas.RAW
    assert incremental.current_raw(spark, path).collect() == incremental.current_silver(spark, path).collect() == []
    assert incremental.current_silver(spark, path).columns == schemas.SILVER.names


def test_settings_are_as_before(spark, run):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    run(spark.createDataFrame(RUNS[0], schemas.PAGES))
    assert spark.conf.get(key) == before


class Kept(dict):
    """Map state of one bucket, as processors use it; counts the passes over all of it."""

    passes = 0

    def exists(self):
        return bool(self)

    getValue = dict.get
    updateValue = dict.__setitem__
    removeKey = dict.pop
    containsKey = dict.__contains__

    def iterator(self):
        self.passes += 1
        return iter(list(self.items()))


class Handle:
    def __init__(self):
        self.states = {}

    def getMapState(self, name, *_):
        return self.states.setdefault(name, Kept())


def test_one_call_settles_all_keys_of_a_bucket():
    """Keys are handed to Python many at once; members are compared again in one pass for all of them."""
    keys, row = (T.StructType.fromDDL(x) for x in ("code string", "url string, price long"))
    event = Row("code", "member", "version", "now")
    best, handle = Best(keys, row, "price", ["url"]), Handle()
    best.init(handle)

    def run(*events):
        told = best.handleInputRows((0,), [event(c, m, v, p and {"url": m, "price": p}) for c, m, v, p in events], None)
        return sorted((r["code"], r["version"], r["was"] and r["was"]["price"], r["now"] and r["now"]["price"]) for r in told)

    assert run(*[(c, m, 1, p) for c in "xyz" for m, p in (("a", 9), ("b", 5))]) == [(c, 1, None, 9) for c in "xyz"]
    # Two that fall and have others: one pass. One whose members are all named: none needed.
    assert run(("x", "a", 2, 1), ("y", "a", 2, None), ("z", "a", 2, 3), ("z", "b", 2, 4)) == [("x", 2, 9, 5), ("y", 2, 9, 5), ("z", 2, 9, 4)]
    assert handle.states["members"].passes == 1
    assert run(("z", "a", 3, None), ("z", "b", 3, None)) == [("z", 3, 4, None)]
    assert run(("z", "c", 1, 7)) == [("z", 4, None, 7)]
    assert handle.states["members"].passes == 1


def test_latest_of_all_keys_of_a_bucket():
    keys, row = (T.StructType.fromDDL(x) for x in ("url string", "url string, page_id long"))
    latest = Latest(keys, row, "page_id")
    latest.init(Handle())
    page_of = Row("url", "page_id")

    def run(*pages):
        return sorted((r["url"], r["version"], r["now"]["page_id"]) for r in latest.handleInputRows((0,), [page_of(*p) for p in pages], None))

    assert run(("a", 1), ("b", 2), ("a", 3), ("c", None)) == [("a", 1, 3), ("b", 1, 2), ("c", 1, None)]
    assert run(("a", 2), ("b", 5), ("c", None)) == [("b", 2, 5)]
