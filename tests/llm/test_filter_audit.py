import re
from itertools import permutations
from math import factorial

import pytest

from brickrow.llm import filter_audit
from brickrow.llm.queries import ORACLES, QUERIES
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"


def failures(doc_id, text, rows):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    tests = {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search("[#$%&*|]", text)),
        "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows),
    }
    return {x for x, failed in tests.items() if failed}


def by_hand(rows, labels):
    """The audit by walking every order over every row."""
    failed = [(s or "", failures(i, t or "", rows), i) for i, t, s in rows]
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    out, total = {}, {}
    for part in {s for s, _, _ in failed}:
        mine = [(f, i) for s, f, i in failed if s == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for k, x in enumerate(order):
                gone = [(f, i) for f, i in left if x in f]
                left = [(f, i) for f, i in left if x not in f]
                out[part, order, k + 1] = [
                    len(left),
                    len(gone),
                    sum(x in f for f, _ in mine) - len(gone),
                    sum(f == {x} for f, _ in mine),
                    sum(i in good for _, i in gone),
                    sum(i in toxic for _, i in gone),
                ]
                total[part, x] = total.get((part, x), 0) + len(gone)
    return {(p, o, k): (*v, total[p, o[k - 1]]) for (p, o, k), v in out.items()}


def told(df):
    names = [*filter_audit.MEASURES, "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in names) for r in df.collect()}


def test_path_counts():
    forward, backward = filter_audit.path_counts()
    for state in range(32):
        n = state.bit_count()
        assert (forward[state], backward[state]) == (factorial(n), factorial(5 - n))
    assert len(filter_audit.edges()) == 80
    # Every order takes one edge of every filter.
    for f in range(5):
        assert sum(w for _, g, w in filter_audit.edges() if g == f) == 120


def test_same_as_sql(spark):
    con = duck(SF)
    assert differences(QUERIES["op13_filter_audit"](spark, SF), con.sql(ORACLES["op13_filter_audit"])) == []


def test_same_as_walking_every_order(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, long, "a"),
        (2, long, "b"),
        (3, long, "a"),
        (4, "SHORT & loud", "a"),
        (5, "x " * 80, "a"),
        (6, "x " * 80, None),
        (7, long.upper(), ""),
        (8, None, "b"),
        (9, "", "a"),
        (10, long + " $", "b"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (3, 1, 0), (3, 0, 1), (5, None, 1), (9, 1, None), (99, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert told(filter_audit.audit(docs, marks)) == by_hand(rows, labels)


def test_hot_text(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', cast(id as string)) as text", "if(id % 2 = 0, 'even', 'odd') as source")
    marks = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = told(filter_audit.audit(docs, marks))
    # 1334 copies; the first, of id 0, is even.
    assert found["even", "EABCD", 1][1] == 666 and found["odd", "EABCD", 1][1] == 667


@pytest.mark.parametrize("empty_labels", [False, True])
def test_odd_rows(spark, odd_docs, no_docs, empty_labels):
    labels = [] if empty_labels else [(1, 1, 0), (None, 1, 1), (3, 1, 1), (7, None, None)]
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.source) for r in odd_docs.select("doc_id", "text", "source").collect()]
    expected = by_hand(rows, [x for x in labels if x[0] is not None])
    assert told(filter_audit.audit(odd_docs, marks)) == expected
    assert filter_audit.audit(no_docs, marks).collect() == []


def test_other_case_of_a_column(spark):
    docs = spark.createDataFrame([(1, "a", "s", "z")], "doc_id bigint, text string, source string, t string").toDF("doc_id", "text", "source", "TEXT")
    marks = spark.createDataFrame([(1, 1, 0, 0)], "doc_id bigint, quality int, toxic int, q int").toDF("doc_id", "quality", "toxic", "Quality")
    assert filter_audit.audit(docs, marks).count() == 600
