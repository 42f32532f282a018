import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from brickrow.llm import phrases
from brickrow.llm.queries import op7_document_fingerprints

SF = "/root/testdata/sf0.01"
TEXT = st.text(alphabet="ab cdé\n😀", max_size=60)


def like(a, b):
    rows = phrases.fingerprints([a, b])
    return float(phrases.likeness(rows[:1], rows[1:])[0])


@given(st.lists(TEXT, min_size=1, max_size=8))
@settings(max_examples=100, deadline=None)
def test_a_fingerprint_depends_on_its_text_alone(texts):
    together = phrases.fingerprints(texts)
    for i, t in enumerate(texts):
        assert (phrases.fingerprints([t])[0] == together[i]).all()


@given(st.lists(st.integers(0, 2**63), min_size=2, max_size=200))
@settings(max_examples=100, deadline=None)
def test_labels_differ_between_neighbours(values):
    x = np.array(values, np.uint64)
    x = x[np.concatenate([[True], x[1:] != x[:-1]])]
    head = np.zeros(len(x), bool)
    head[0] = True
    label = phrases.labels(x, head)
    assert label.max() < 6 and (label[1:] != label[:-1]).all()


def test_equal_substrings_are_cut_alike_wherever_they_stand():
    r = random.Random(1)
    core = "".join(r.choice("abcdefgh ") for _ in range(4000))
    for lead in ("", "x", "some other beginning, of any length "):
        assert like(core, lead + core) > 0.85
        assert like(core, core + lead) > 0.85
    other = "".join(r.choice("abcdefgh ") for _ in range(4000))
    assert like(core, other) < 0.1
    half = core[:2000] + other[2000:]
    assert 0.15 < like(core, half) < 0.55
    names, owner = phrases.level(phrases.mix(np.frombuffer(core.encode("utf-32-le"), "<u4").astype(np.uint64)), np.zeros(4000, int))
    assert 2 <= 4000 / len(names) <= 6 and not owner.any()


def test_tiny_texts():
    assert like("", "") == 1 and like("", "a") == 0 and like("a", "a") == 1 and like("aaaa", "aaaaa") < 1
    assert phrases.as_hex(phrases.fingerprints([""])) == ["0" * 256]


def check(rows, texts):
    """``texts``: (id, text) in order."""
    want = []
    for i, (doc_id, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1]
        changed = phrases.edited(text, following)
        a, b, c = phrases.fingerprints([text, changed, following])
        near = phrases.likeness(np.stack([a, a]), np.stack([b, c]))
        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), a.astype(">u2").tobytes().hex(), near[0], near[1]))
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.near_edited, r.near_next) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query_compares_with_the_next_document(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    rows = op7_document_fingerprints(spark, SF).collect()
    check(rows, docs)
    long = [r for r in rows if r.n_chars > 1000]
    assert np.mean([r.near_edited for r in long]) > 0.5 > 0.1 > np.mean([r.near_next for r in long])


def test_edits():
    assert phrases.edited("abcdefgh", "XYZ") == "abcdefXY"
    assert phrases.edited("abcdefgh", "X") == "abcdefX"
    assert phrases.edited("abc", "X") == "abc" and phrases.edited("", "X") == ""


def test_odd_documents(spark, odd_docs):
    rows = phrases.compare_edits(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r.n_chars for r in rows) == sorted(len(r.text or "") for r in odd_docs.collect())
    known = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = sorted((r.doc_id, r.text or "") for r in known.collect())
    check(phrases.compare_edits(known).collect(), texts)
    one = known.where("doc_id = 7")
    check(phrases.compare_edits(one).collect(), [(r.doc_id, r.text) for r in one.collect()])


def test_no_documents(no_docs):
    assert phrases.compare_edits(no_docs).collect() == []
