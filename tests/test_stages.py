"""Files in and out, stage by stage."""

import logging

import pytest
from pyspark.errors import AnalysisException

from brickrow import schemas
from brickrow.operators import clean, frontier, listing, quality
from brickrow.plans import stages
from brickrow.proof import render
from brickrow.sources import files, records, scratch, tables, versions

SITE = "https://site.example"


def test_csv_keeps_quotes_breaks_accents_and_zeros(spark, tmp_path):
    row = ('say "hi", you', "a\nb", " é ", "0123", None)
    table = spark.createDataFrame([row], "a string, b string, c string, d string, e string")
    path = tables.write_csv(table, str(tmp_path / "t"), multiline=True)
    assert tables.read_csv(spark, path, multiline=True).first() == row
    flat = tables.write_csv(table, str(tmp_path / "u"))
    assert tables.read_csv(spark, flat).first().b == "a b"


@pytest.mark.parametrize("block,broadcast_blocks", [(64, 10**6), (7, 10**6), (64, 0), (10**6, 10**6)])
def test_records_with_line_breaks_in_several_tasks(spark, tmp_path, block, broadcast_blocks):
    """Also where a record covers whole blocks; equal to the reader that takes a file in one task."""
    texts = ["plain", "two\nlines", "a\n\n\nb", 'say "hi"\nto "all"', '"', "x" * 150 + "\n" + "y" * 150, "", None, "\n", "é\nü, ö"]
    rows = [(f"k{i}", texts[i % len(texts)], f"{texts[(i * 7 + 3) % len(texts)]}") for i in range(200)]
    table = spark.createDataFrame(rows, "a string, b string, c string").coalesce(2)
    path = tables.write_csv(table, str(tmp_path / "t"), multiline=True)
    expected = spark.read.options(**tables.CSV_FORMAT).option("multiLine", True).csv(path)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(block))
    try:
        lines = records.lines_of(spark, path)
        n_blocks = lines.select("file", "block").distinct().count()
        assert n_blocks >= (20 if block < 100 else 1) and lines.rdd.getNumPartitions() >= (8 if block < 100 else 1)
        assert records.records_of(lines, broadcast_blocks).count() == 200
        found = records.read_records(spark, path, tables.CSV_FORMAT)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    finally:
        spark.conf.set(key, before)


def test_windows_line_ends_and_a_missing_last_one(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n2,z')
    read = tables.read_csv(spark, str(tmp_path / "w.csv"), multiline=True)
    assert sorted(map(tuple, read.collect())) == [("1", "x\ny"), ("2", "z")]


def test_saved_rows_are_counted(spark, tmp_path, caplog):
    with caplog.at_level(logging.INFO, logger="brickrow.sources.tables"):
        tables.write_table(spark.range(7).repartition(3), str(tmp_path / "a"))
        tables.write_csv(spark.range(9).orderBy("id"), str(tmp_path / "b"))
        tables.write_table(spark.createDataFrame([], "a int").where("a > 1"), str(tmp_path / "c"))
    assert [r.args[0] for r in caplog.records] == [7, 9, 0]


def test_csv_missing_values(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('property_url,price_eur,postal_code\nu,N/A,0123\nv,"",-\nw,#N/A,none\n', "utf-8")
    got = tables.read_csv(spark, str(path)).collect()
    assert [tuple(r) for r in got] == [("u", None, "0123"), ("v", None, "-"), ("w", None, "none")]
    with pytest.raises(AnalysisException):
        tables.read_csv(spark, str(tmp_path / "none"))


def test_url_list_keeps_its_order(spark, tmp_path):
    urls = [f"{SITE}/en/detail/loft/{(i * 7919) % 1000}" for i in range(1000)]
    table = spark.createDataFrame(list(enumerate(urls)), "first_seen bigint, url string").repartition(5)
    path = tables.write_url_list(table, str(tmp_path / "urls"), ["first_seen"])
    read = tables.read_urls_csv(spark, path)
    assert read.columns == ["link", "seq"]
    assert [r.link for r in read.orderBy("seq").collect()] == urls
    loaded = frontier.take_first(frontier.load_urls(read), 3)
    assert [r.url for r in loaded.orderBy("first_seen").collect()] == urls[:3]


def test_staging_a_list(spark, tmp_path):
    source = tmp_path / "urls_raw.csv"
    source.write_text(
        f"url\n{SITE}/en/detail/sale/house/1\n{SITE}/en/projectdetail/2\n"
        f"{SITE}/en/detail/sale/house/1\n{SITE}/en/detail/rent/house/3\n"
    )
    out = str(tmp_path / "staged")
    assert tuple(stages.stage(spark, str(source), out)) == (4, 3, 2, 3)
    staged = [r.url for r in tables.read_csv(spark, out).collect()]
    assert staged == [f"{SITE}/en/detail/sale/house/1", f"{SITE}/en/projectdetail/2"]
    assert stages.stage(spark, str(tmp_path / "none"), str(tmp_path / "x")) is None
    assert not (tmp_path / "x").exists()
    assert stages.stage_all(spark, str(source), str(tmp_path / "all")) == (4, 3)
    with pytest.raises(AnalysisException):
        stages.stage_all(spark, str(tmp_path / "none"), str(tmp_path / "y"))


def test_all_stages(spark, tmp_path):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").limit(400)
    pages = render.listing_pages(orders)
    urls = stages.collect(render.result_pages(orders), render.SITE, str(tmp_path / "urls"))
    listed = frontier.load_urls(tables.read_urls_csv(spark, urls))
    raw_path = stages.scrape(tables.read_urls_csv(spark, urls), pages, str(tmp_path / "raw"))
    raw = tables.read_table(spark, raw_path)
    assert raw.schema == schemas.RAW
    assert raw.count() == listed.count()
    counts = stages.refine(raw, str(tmp_path / "silver"))
    silver = tables.read_silver(spark, str(tmp_path / "silver"))
    assert silver.schema.names == schemas.SILVER.names
    assert counts.n_rows == silver.count() > 0
    assert silver.exceptAll(clean.silver(raw)).isEmpty()
    limited = stages.raw_records(tables.read_urls_csv(spark, urls), pages, limit=10)
    assert limited.count() == 10


def test_failing_gate_publishes_nothing(spark, tmp_path):
    raw = spark.createDataFrame([("u", 5)], "property_url string, price_eur bigint")
    with pytest.raises(quality.QualityGateError):
        stages.refine(raw, str(tmp_path / "silver"))
    with pytest.raises(FileNotFoundError):
        tables.read_silver(spark, str(tmp_path / "silver"))


def test_province_with_a_slash_is_a_folder_and_comes_back(spark, tmp_path):
    raw = listing.to_raw(
        spark.createDataFrame([("u", "c", 20000, "0999"), ("v", "d", 20000, "1000")], "property_url string, property_code string, price_eur bigint, postal_code string")
    )
    stages.publish(clean.silver(raw), str(tmp_path / "s"))
    got = {r.property_url: r.province for r in tables.read_silver(spark, str(tmp_path / "s")).collect()}
    assert got == {"u": "Outside Belgium / Invalid", "v": "Brussels"}


def test_scratch_follows_the_session(spark):
    path = scratch.scratch_dir(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")
    assert not files.exists(spark, path) and files.exists(spark, path.rpartition("/")[0])


def test_a_version_is_switched_whole(spark, tmp_path):
    path = str(tmp_path / "table")
    assert versions.current(spark, path) == {}
    old, new = versions.new_folder(path), versions.new_folder(path)
    for folder in (old, new):
        spark.range(3).write.parquet(f"{path}/{folder}")
    versions.switch(spark, path, {"a": old, "b": old}, keep=0)
    assert versions.current(spark, path) == {"a": old, "b": old}
    assert not files.exists(spark, f"{path}/{new}")  # nothing referred to it
    spark.range(4).write.parquet(f"{path}/{new}")
    versions.switch(spark, path, {"a": new, "b": old}, keep=0)
    assert files.exists(spark, f"{path}/{old}")
    # A pointer that was not completed does not count.
    (tmp_path / "table" / "pointer-000000000099").write_text('{"a": ')
    assert versions.current(spark, path) == {"a": new, "b": old}
    versions.switch(spark, path, {"a": new, "b": new}, keep=0)
    assert versions.current(spark, path) == {"a": new, "b": new}
    assert sum(n.startswith("data-") for n in files.names(spark, path)) == 1


def silver_of(spark, *rows):
    return clean.silver(listing.to_raw(spark.createDataFrame(list(rows), "property_url string, price_eur bigint, property_code string")))


def test_a_reader_finishes_while_a_version_is_published(spark, tmp_path):
    path = str(tmp_path / "silver")
    stages.publish(silver_of(spark, ("u", 20_000, "a"), ("v", 30_000, "b")), path)
    before = tables.read_silver(spark, path)
    stages.publish(silver_of(spark, ("w", 40_000, "c")), path)
    assert before.count() == 2 and tables.read_silver(spark, path).count() == 1
    stages.publish(silver_of(spark, ("w", 40_000, "c")), path)
    assert before.agg({"price_eur": "sum"}).first()[0] == 50_000


def test_two_writers_do_not_take_one_number(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    versions.switch(spark, path, {"a": "data-1"})
    listed = files.names(spark, path)
    versions.switch(spark, path, {"a": "data-2"})
    with monkeypatch.context() as m:
        m.setattr(files, "names", lambda *_: listed)  # as the slower writer saw the folder
        with pytest.raises(FileExistsError):
            versions.switch(spark, path, {"a": "data-3"})
    assert versions.current(spark, path) == {"a": "data-2"}


def test_the_gate_needs_no_second_read(spark, tmp_path, monkeypatch):
    """What it asks for is counted by the write."""
    monkeypatch.setattr(tables, "read_silver_folder", lambda *_: pytest.fail("read again"))
    counts = stages.publish(silver_of(spark, ("u", 20_000, "a"), ("v", 30_000, "b")), str(tmp_path / "s"))
    assert (counts.n_rows, counts.n_null_prices, counts.n_outside) == (2, 0, 0)


def test_runs_append_what_is_new(spark, tmp_path):
    page = "<h4>Build year</h4><p>{}</p>".format
    url = (SITE + "/en/detail/loft/{}").format
    name, path = "raw_runs_of_a_test", str(tmp_path / "raw")

    def run(rows):
        pages = spark.createDataFrame(rows, schemas.PAGES)
        return stages.append_new(pages.select("url"), pages, name, buckets=4, path=path)

    def files_now():
        return {p.name: p.stat().st_mtime_ns for p in (tmp_path / "raw").glob("*.parquet")}

    assert stages.current_raw(spark, name) is None
    assert run([(i, url(i), page(1900 + i), None) for i in range(300)] + [(900, url(900), None, None)]) == 1
    first = files_now()
    assert len(first) == 4  # one file for each bucket
    assert run([(1000, url(900), page(1950), None), (1001, url(5), page(1), None)]) == 2
    second = files_now()
    assert first.items() <= second.items() and len(second) - len(first) <= 2
    raw = {r.property_url: r.build_year for r in stages.current_raw(spark, name).collect()}
    assert raw == {**{url(i): 1900 + i for i in range(300)}, url(900): 1950}  # what was read before is not scraped again
    assert stages.current_raw(spark, name).schema == schemas.RAW
    spark.sql(f"DROP TABLE {name}")


def test_a_failed_gate_leaves_the_published_version(spark, tmp_path):
    path = str(tmp_path / "silver")
    good = clean.silver(listing.to_raw(spark.createDataFrame([("u", 20000)], "property_url string, price_eur bigint")))
    stages.publish(good, path)
    with pytest.raises(quality.QualityGateError):
        stages.publish(good.where("price_eur < 0"), path)
    assert tables.read_silver(spark, path).count() == 1
    assert sum(n.startswith("data-") for n in files.names(spark, path)) == 1


def test_silver_csv_is_dearest_first(spark, tmp_path):
    rows = [(f"u{i}", f"c{i}", 20000 + (i * 7919) % 1000) for i in range(300)]
    raw = spark.createDataFrame(rows, "property_url string, property_code string, price_eur bigint").repartition(4)
    stages.publish(clean.silver(listing.to_raw(raw)), str(tmp_path / "s"), str(tmp_path / "csv"))
    read = tables.read_urls_csv(spark, str(tmp_path / "csv")).orderBy("seq").collect()
    assert [int(r.price_eur) for r in read] == sorted((p for _, _, p in rows), reverse=True)
