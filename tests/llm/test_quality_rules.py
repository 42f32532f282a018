import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brickrow.llm import quality_rules as rules
from brickrow.llm.queries import ORACLES, op9_quality_rules
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@given(st.text(alphabet="ab \n\t#*é\x1c\x85\xa0", max_size=80))
@settings(max_examples=300, deadline=None)
def test_measures_equal_brute_force(text):
    assert rules.measure(text) == brute(text)


def test_query_equals_sql(spark):
    assert differences(op9_quality_rules(spark, SF), duck(SF).sql(ORACLES["op9_quality_rules"])) == []


def test_quantiles_are_within_the_bins_width(spark):
    values = [(None, "s", i * 7 % 1000) for i in range(1000)]
    rows = spark.createDataFrame(values, "lang string, source string, v bigint").select("lang", "source", F.lit("m").alias("measure"), rules.bin_of(F.col("v")).alias("bin"))
    sketch = rows.groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n"))
    (q,) = rules.quartiles(sketch, ["lang", "source"]).collect()
    assert q.n_docs == 1000 and q.q1 == pytest.approx(249.5, rel=0.02) and q.q3 == pytest.approx(749.5, rel=0.02)


def test_thresholds_adapt_to_language_and_source(spark):
    def docs(source, mark, n, first):
        words = " ".join(f"word{i}{mark if i % 4 == 0 else ''}" for i in range(80))
        return [(first + i, words + f" end{i}", "en", source) for i in range(n)]

    odd = "word#### " * 2 + " ".join(f"w{i}####" for i in range(80))
    rows = docs("plain", "", 150, 0) + docs("symbols", "#", 150, 1000) + [(5000, odd, "en", "plain"), (5001, docs("", "#", 1, 0)[0][1], "en", "plain"), (5002, docs("", "#", 1, 0)[0][1], "en", "symbols")]
    kept = {r.doc_id: r.kept for r in rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert all(kept[i] for i in [*range(150), *range(1000, 1150), 5002])
    assert not kept[5000] and not kept[5001]  # usual in one source, an outlier in the other


def test_a_small_source_uses_its_language(spark):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(i, f"{text} {i}", "en", "big") for i in range(120)] + [(500, " ".join(f"w{i}##" for i in range(80)), "en", "small")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in rules.judge(docs).collect()}
    assert not kept[500]
    assert {r.doc_id: r.kept for r in rules.judge(docs, least=1).collect()}[500]


def test_odd_documents(odd_docs):
    rows = rules.judge(odd_docs).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows), key=repr)
    assert got == sorted(((r.doc_id, *brute(r.text or "")) for r in odd_docs.collect()), key=repr)
    assert all(r.base_failed for r in rows if r.n_words < 50) and not any(r.kept for r in rows if r.base_failed)


def test_no_documents(no_docs):
    assert rules.judge(no_docs).collect() == []
