import random
import re

import numpy as np
import pytest

from brickrow.llm import jaccard_join as join
from brickrow.llm.components import components
from brickrow.llm.queries import ORACLES, op2_jaccard_join
from brickrow.llm.shingles import shingles
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """For every row: id, size of its set, smallest id that links reach."""
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(doc_id, ids.get(find(i), doc_id))
    return sorted(((d, len(s), ids.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def got(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = join.classes(docs).select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in found), key=repr)


def texts_like(r, n, sizes, edits, vocabulary=10**6):
    """Texts of random words, some of them copies of others with a few words changed, cut or added."""
    out = []
    for _ in range(n):
        if out and r.random() < 0.7:
            words = list(r.choice(out))
            for _ in range(r.randint(0, edits)):
                at = r.randrange(len(words) + 1)
                words[at : at + r.randint(0, 1)] = [str(r.randrange(vocabulary))] * r.randint(0, 1)
            words = words or ["w"]
        else:
            words = [str(r.randrange(vocabulary)) for _ in range(r.choice(sizes))]
        out.append(words)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("seed, sizes, edits, vocabulary", [(1, range(4, 12), 2, 10**6), (2, range(5, 45), 3, 10**6), (3, range(30, 140), 4, 10**6), (4, range(5, 30), 2, 3), (5, [300, 600], 20, 10**6)])
def test_near_copies_of_all_sizes_equal_brute_force(spark, seed, sizes, edits, vocabulary):
    r = random.Random(seed)
    rows = list(enumerate(texts_like(r, 90, list(sizes), edits, vocabulary)))
    r.shuffle(rows)
    assert got(spark, rows) == brute(rows)


def test_three_shingles_against_four(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "0 a b c d e f g"), (4, "p q r s t u v"), (5, "p q r s t u"), (6, "p q r s t u w")]
    found = got(spark, rows)
    assert found == brute(rows)
    assert [c for _, _, c in found] == [1, 1, 1, 4, 5, 6]


def test_all_links_are_counted(spark):
    """A group of near copies that are nearly all linked with each other, small sets, an exact copy."""
    r = random.Random(5)
    base = [str(r.randrange(10**6)) for _ in range(80)]
    texts = [" ".join(str(r.randrange(10**6)) if k == at else w for k, w in enumerate(base)) for at in range(0, 80, 2)]
    texts += texts_like(r, 40, list(range(5, 30)), 2) + ["a b c d e f g", "a b c d e f g h", texts[3], ""]
    rows = list(enumerate(texts))
    sets = {brute_set(t) for t in texts} - {frozenset()}
    want = {s: sum(s != t and 100 * len(s & t) >= 75 * len(s | t) for t in sets) for s in sets}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {x.doc_id: x.n_links for x in join.classes(docs).collect()}
    assert found == {i: want.get(brute_set(t), 0) for i, t in rows}
    assert max(found.values()) >= 30


def test_a_hot_group_and_a_common_line(spark):
    """Many near copies around the threshold, a line that a third of the texts share, exact copies."""
    r = random.Random(9)
    base = [str(r.randrange(10**6)) for _ in range(60)]
    line = "licensed under the terms of some common licence text that is long enough"
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(r.randint(0, 4)):
            words[r.randrange(60)] = str(r.randrange(10**6))
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, line + " " + " ".join(str(r.randrange(10**6)) for _ in range(r.randint(20, 60)))) for i in range(120)]
    rows += [(2000 + i, rows[0][1]) for i in range(90)]
    assert got(spark, rows) == brute(rows)


def test_too_few_segments_are_made_up_for(spark):
    """With hardly any segments every record lacks some: the fallback has to find all links."""
    r = random.Random(11)
    rows = list(enumerate(texts_like(r, 60, list(range(10, 60)), 2)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    records = join.described(docs, 2).selectExpr("*", "rec as node", "n_shingles as n")
    assert not join.lacking(records).isEmpty()
    assert join.lacking(join.described(docs).selectExpr("*", "rec as node", "n_shingles as n")).isEmpty()
    for found in (join.classes(docs, 2), join.placed(docs, False, 2)):
        assert sorted((tuple(x) for x in found.select("doc_id", "n_shingles", "component_id").collect()), key=repr) == brute(rows)


def test_other_case_of_a_column(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "z"), (2, "a b c d e f", "y")], "doc_id bigint, text string, t string").toDF("doc_id", "text", "TEXT")
    assert sorted(tuple(x) for x in join.classes(docs).collect()) == [(1, 2, 1, 0), (2, 2, 1, 0)]
    assert [x[0] for x in join.representatives(docs).collect()] == [1]


def test_one_missed_segment_is_enough_for_two_linked_sets():
    """Of two linked sets, each probing as many segments as required finds the other."""
    r = np.random.default_rng(2)
    for n in (8, 20, 40, 100, 500):
        x = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        for _ in range(20):
            drop = int(r.integers(0, n // 7 + 1))
            y = np.unique(np.concatenate([x[drop:], r.integers(0, 2**63, drop).astype(np.uint64)]))
            if join.linked(x, y):
                assert np.isin(join.signatures(x) & ~np.uint64(255), join.signatures(y) & ~np.uint64(255)).any()


def test_sketches_never_differ_more_than_sets():
    r = np.random.default_rng(4)
    for _ in range(50):
        x = np.unique(r.integers(0, 2**63, 200).astype(np.uint64))
        y = np.unique(np.concatenate([x[r.random(len(x)) < 0.9], r.integers(0, 2**63, 20).astype(np.uint64)]))
        a, b = (np.frombuffer(join.sketch(v), np.uint64) for v in (x, y))
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))


def test_words_are_cut_and_folded_as_stated():
    texts = ["A b\tC d e", "a B c\x0bd E", "ä b c d e", "Ä b c d e", "a\x1cb c d e f", "a\xa0b c d e f"]
    sets = [tuple(shingles(t).tolist()) for t in texts]
    assert sets[0] == sets[1] and sets[2] != sets[3]
    for t, s in zip(texts, sets):
        assert len(s) == len(brute_set(t))
    assert len(shingles("")) == len(shingles(" \n")) == 0
    long = "y" * 5000 + " " + "z" * 5000
    assert shingles(long).tolist() != shingles("y" * 5000 + " " + "z" * 4999 + "y").tolist()


def test_query_equals_sql(spark):
    assert differences(op2_jaccard_join(spark, SF), duck(SF).sql(ORACLES["op2_jaccard_join"])) == []


def test_odd_documents(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    found = join.classes(odd_docs).select("doc_id", "n_shingles", "component_id").collect()
    want = brute(rows)
    # A row without shingles is its own component.
    want = sorted(((d, n, c if n else d) for d, n, c in want), key=repr)
    assert sorted((tuple(r) for r in found), key=repr) == want


def test_representatives(odd_docs):
    kept = join.representatives(odd_docs)
    assert kept.columns == odd_docs.columns and kept.dtypes == odd_docs.dtypes
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    texts = [t for _, t in rows if t and t.strip()]
    assert len(texts) == len(set(texts)) and texts.count("one two three four five six") == 1
    assert (5, "one two three four five six") in rows and (3, "another text with the same id") in rows
    assert sum(not (t and t.strip()) for _, t in rows) == odd_docs.where("trim(coalesce(translate(text, '\t\n', '  '), '')) = ''").count()


def test_no_documents(no_docs):
    assert join.classes(no_docs).collect() == []
    assert join.representatives(no_docs).collect() == []


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
