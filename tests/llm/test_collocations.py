import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from brickrow.llm import collocations
from brickrow.llm.queries import ORACLES, QUERIES
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    found = [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER))]
    return [p for p in found if p]


def by_hand(rows, least, top):
    """The report from ``(lang, text)`` rows, counted phrase by phrase."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        count = f.setdefault(lang, Counter())
        for p in pieces(text):
            n[lang] += len(p)
            for size in (1, 2, 3, 4):
                for i in range(len(p) - size + 1):
                    count[tuple(p[i : i + size])] += 1
    out = []
    for lang, count in f.items():
        found = []
        for g, a in count.items():
            if len(g) < 2 or a < least:
                continue
            longer = [b for h, b in count.items() if len(g) < len(h) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, k, l, r = min((2_000_000 * a // (count[g[:k]] + count[g[k:]]), k, count[g[:k]], count[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), l, r))
        for i, (score, a, phrase, l, r) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def told(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def noise(seed, n_docs=60, vocabulary=12):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "ß", "THE"]
    shared = " ".join(r.choice(words) for _ in range(40))
    rows = []
    for _ in range(n_docs):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ", ;"]) for _ in range(r.randrange(120)))
        rows.append((r.choice(["en", "de", None]), text + shared if r.random() < 0.4 else text))
    return rows


@pytest.mark.parametrize("period,longest", [(1, 1), (3, 5), (24, 96)])
def test_chunks_hold_every_phrase_once(period, longest):
    texts = [t for _, t in noise(3)] + [None, "", " \t", ".;\n", "one", "a b c d e"]
    powers = collocations.Powers()
    found, own, owner = collocations.chunks_of(pa.array(texts), powers, period, longest)
    assert own.max() <= longest
    counted = Counter()
    for chunk, n in zip(found, own.tolist()):
        seen = 0
        for p in pieces(chunk.decode()):
            for i in range(len(p)):
                if seen < n:
                    counted.update(tuple(p[i : i + size]) for size in (1, 2, 3, 4) if i + size <= len(p))
                seen += 1
    expected = Counter(tuple(p[i : i + s]) for t in texts for p in pieces(t) for s in (1, 2, 3, 4) for i in range(len(p) - s + 1))
    assert counted == expected


def test_chunks_depend_on_content():
    passage = " ".join(f"word{i}" for i in range(400))
    powers = collocations.Powers()
    alone, *_ = collocations.chunks_of(pa.array([passage]), powers)
    moved, *_ = collocations.chunks_of(pa.array(["some other words " * 7 + passage]), powers)
    # All but the first chunk of the passage come again.
    assert set(alone[1:]) <= set(moved) and len(alone) > 5


def test_word_hashes_are_of_the_word_alone():
    powers = collocations.Powers()
    data = b"ab ab xab.ab ab"
    words = collocations.words_of(data, np.array([0, 5, len(data)]), powers)
    assert [data[a:b] for a, b in zip(words.start, words.end)] == [b"ab", b"ab", b"xab", b"ab", b"ab"]
    assert len(set(words.hash[[0, 1, 3, 4]].tolist())) == 1 and words.hash[2] != words.hash[0]
    assert words.owner.tolist() == [0, 0, 1, 1, 1] and len(set(words.piece.tolist())) == 3


def test_string_borders_cut_words():
    powers = collocations.Powers()
    words = collocations.words_of(b"abcd", np.array([0, 2, 2, 4]), powers)
    assert list(zip(words.start.tolist(), words.end.tolist(), words.owner.tolist())) == [(0, 2, 0), (2, 4, 2)]


@pytest.mark.parametrize("seed,period,most_bits", [(1, 24, 1 << 28), (2, 2, 1 << 15)])
def test_same_as_by_hand(spark, seed, period, most_bits):
    rows = noise(seed)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert told(collocations.mine(docs, least=5, top=50, period=period, most_bits=most_bits)) == by_hand(rows, 5, 50)


def test_a_full_filter_changes_nothing(spark):
    rows = noise(4)
    docs = spark.createDataFrame(rows, "lang string, text string")
    chunks = collocations.dictionary(docs)
    full = collocations.Filter(np.full(4096, 255, np.uint8))
    table = collocations.phrases(chunks, full, full, 5)
    expected = Counter()
    for lang, text in rows:
        for p in pieces(text):
            expected.update((lang or "und", " ".join(p[i : i + s])) for s in (1, 2, 3, 4) for i in range(len(p) - s + 1))
    assert {(r.lang, r.phrase): r.f for r in table.collect()} == {k: n for k, n in expected.items() if n >= 5}


def test_same_as_sql(spark):
    con = duck(SF)
    assert differences(QUERIES["op12_collocations"](spark, SF), con.sql(ORACLES["op12_collocations"])) == []


def test_counts_past_64_bits(spark):
    big = 9 * 10**17
    rows = [("en", 1, "a", big), ("en", 1, "b", big), ("en", 2, "a b", big), ("en", 3, "a b c", big // 5 * 4 - 1), ("en", 1, "c", big), ("en", 2, "b c", big)]
    table = spark.createDataFrame(rows, "lang string, size int, phrase string, f bigint")
    found = {r.phrase: (r.a, r.l, r.r, r.score) for r in collocations.scored(table).collect()}
    assert found["a b"] == (big, big, big, 1_000_000)
    assert found["a b c"] == (big // 5 * 4 - 1, big, big, 2_000_000 * (big // 5 * 4 - 1) // (2 * big))


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.lang, r.text) for r in odd_docs.select("lang", "text").collect()]
    assert told(collocations.mine(odd_docs, least=2, top=30)) == by_hand(rows, 2, 30)
    assert collocations.mine(no_docs).collect() == []


def test_very_long_texts(spark):
    rows = [("en", "a " * 300_000), ("en", "b" * 400_000 + " c"), ("en", "d e. " * 50_000)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    found = {r.phrase: (r.a, r.n) for r in collocations.mine(docs).collect()}
    assert found == {"a a a a": (299_997, 400_002), "d e": (50_000, 400_002)}


def test_other_case_of_a_column(spark):
    docs = spark.createDataFrame([(1, "a b " * 40, "en", "z")], "doc_id bigint, text string, lang string, t string").toDF("doc_id", "text", "lang", "TEXT")
    assert collocations.mine(docs).count() > 0
