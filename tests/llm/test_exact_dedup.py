import hashlib
import re

import pytest
from pyspark.sql import functions as F

from brickrow.llm import exact_dedup
from brickrow.llm.queries import ORACLES, QUERIES
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"


def by_hand(rows):
    """``(doc_id, keep_id, group_size, kept, sha)`` of every row, from a list of ``(doc_id, text)``."""
    keys = [hashlib.sha256(re.sub(r"[\x20\x09-\x0d]+", " ", t or "").encode()).hexdigest() for _, t in rows]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        group = [(rows[j][0] is None, rows[j][0] or 0) for j in range(len(rows)) if keys[j] == keys[i]]
        least = min(group)
        out.append((doc_id, None if least[0] else least[1], len(group), (doc_id is None, doc_id or 0) == least, keys[i]))
    return out


def told(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_same_as_sql(spark):
    con = duck(SF)
    assert differences(QUERIES["op11_exact_dedup"](spark, SF), con.sql(ORACLES["op11_exact_dedup"])) == []


@pytest.mark.parametrize("most_bits", [1 << 15, 1 << 30])
def test_groups_of_every_size(spark, most_bits):
    texts = [f"text {i}" for i in range(3000)] + ["a  b", "a b", "a\tb\n", "a b"] * 300 + [None, "", " ", "\x0b"]
    rows = [((i * 7919) % 100_003, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    # With the smallest filter nearly all positions are set, and the result is the same.
    assert told(exact_dedup.judge(docs, most_bits)) == sorted(by_hand(rows), key=repr)


def test_large_groups_are_not_shuffled_together(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.floor(F.col("id") / 6))).alias("text"))
    found = exact_dedup.judge(rows)
    sizes = {r.group_size: r.n for r in found.groupBy("group_size").agg(F.count("*").alias("n")).collect()}
    assert sizes == {2000: 2000, 4: 4000}
    assert found.where("kept").count() == 1001
    assert found.where("group_size = 2000").select("keep_id").distinct().collect() == [(0,)]


def test_alone_pass_without_a_shuffle(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    rows = exact_dedup.digests(docs)
    buckets = exact_dedup.buckets_for(20_000)
    marked = exact_dedup.tested(rows, exact_dedup.repeated_filter(rows, buckets), buckets)
    # Of rows without an equal, few reach the shuffle.
    assert marked.where("maybe").count() < 20_000 * 0.03


def test_odd_rows(odd_docs, no_docs):
    found = told(exact_dedup.judge(odd_docs))
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    expected = sorted(by_hand(rows), key=repr)
    # Of rows that repeat id and text one stays; the rest is as told by hand.
    repeated = [x for x in expected if expected.count(x) > 1 and x[3]]
    assert len(repeated) == 2
    expected.remove(repeated[0])
    expected.append((*repeated[0][:3], False, repeated[0][4]))
    assert found == sorted(expected, key=repr)
    assert told(exact_dedup.judge(no_docs)) == []


def test_unique_keeps_rows_whole(odd_docs, no_docs):
    kept = exact_dedup.unique(odd_docs)
    assert kept.columns == odd_docs.columns
    verdicts = exact_dedup.judge(odd_docs).where("kept")
    ids = lambda df: sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())
    assert ids(kept) == ids(verdicts)
    assert exact_dedup.unique(no_docs).collect() == []


def test_other_case_of_a_column(spark):
    docs = spark.createDataFrame([(1, "a", "z"), (2, "a", "y")], "doc_id bigint, text string, t string").toDF("doc_id", "text", "TEXT")
    assert [(r.doc_id, r.keep_id) for r in exact_dedup.judge(docs).orderBy("doc_id").collect()] == [(1, 1), (2, 1)]
    assert exact_dedup.unique(docs).collect() == [(1, "a", "z")]


def test_native(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id bigint, text string")
    plan = exact_dedup.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
