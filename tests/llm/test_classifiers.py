import collections
import itertools
import pickle
import re
import tracemalloc
import zlib

import numpy as np
import pytest

from brickrow.llm import quality_classifier as quality
from brickrow.llm import toxicity
from brickrow.llm.queries import op5_quality_classifier, op8_toxicity

SF = "/root/testdata/sf0.1"


def joined(spark, rows, column):
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]


def rates(pairs):
    pos = [r.predicted for r, y in pairs if y == 1]
    neg = [r.predicted for r, y in pairs if y == 0]
    return np.mean(pos), np.mean(neg)


def test_quality_on_held_out_labels(spark):
    rows = op5_quality_classifier(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    kept, wrong = rates(joined(spark, rows, "quality"))
    assert kept >= 0.98 and wrong <= 0.1


def test_toxicity_on_held_out_labels(spark):
    rows = op8_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    found, wrong = rates(joined(spark, rows, "toxic"))
    assert found >= 0.8 and wrong <= 0.02
    assert any(r.evidence for r in rows if r.predicted)


def test_toxicity_of_few_examples_and_copies(spark):
    """Too few examples for a lexicon: all their terms count, and a copy of an example is like it."""
    words = [[f"{chr(97 + i)}{chr(97 + j)}{w}" for w in ("qualo", "remis", "tubex", "vondi")] for i in range(5) for j in range(5)]
    rows = [(i, " ".join(w), int(i % 2)) for i, w in enumerate(words)]
    rows += [(1000 + i, t + " common words", y) for i, t, y in rows]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.vocabulary and not model.lexicon.any()
    learned = [(i, t, y) for i, t, y in rows if i in set(model.ids.tolist())]
    for (i, _, y), (score, near) in zip(learned, model.score([t for _, t, _ in learned], {})):
        assert near[0] == i and (score >= toxicity.THRESHOLD) == bool(y)
    common = model.vocabulary["common"]
    assert model.idf[common] == pytest.approx(np.log((1 + 50) / (1 + 25)) + 1)


def test_attention_gradient_by_differences():
    """Learning lowers the loss, and the weighted passages explain the score."""
    r = np.random.default_rng(0)
    x = r.normal(size=(300, quality.WIDTH))
    text = np.sort(r.integers(0, 60, 300))
    text = np.unique(text, return_inverse=True)[1]
    y = np.array([float(x[text == t, 0].max() > 1) for t in range(text.max() + 1)])
    weights = quality.learn(x, text, y, np.ones(len(y)))
    f = quality._forward(weights, x, np.flatnonzero(np.diff(text, prepend=-1)), text)
    assert np.mean((f["score"] > 0.5) == y) > 0.85
    sums = np.bincount(text, f["attention"])
    assert np.allclose(sums, 1)


def test_passages_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["one two three " * 50, "", "*** ### !!!", " ", "Ünï cödé " * 70]
    x, owner = quality.passages(texts)
    for i, t in enumerate(texts):
        alone, _ = quality.passages([t])
        assert np.allclose(x[owner == i], alone)
    assert np.bincount(owner).tolist() == [3, 1, 1, 1, 3]


def test_nearest_examples_equal_all_cosines():
    r = np.random.default_rng(3)
    vectors = []
    for _ in range(500):
        t = np.sort(r.choice(40, r.integers(0, 6), replace=False))
        w = r.random(len(t)) + 0.1
        vectors.append((t, w / np.sqrt((w * w).sum()) if len(t) else w))
    vectors += vectors[:80]  # ties
    index = toxicity.Index(vectors, 40)
    dense = np.zeros((len(vectors), 40))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for q in range(0, len(vectors), 7):
        t, w = vectors[q]
        full = dense @ dense[q]
        order = [i for i in np.lexsort((np.arange(len(full)), -full.round(9))) if full[i] > 0 and i != q][:15]
        ids, cosines = index.nearest(t, w, 15, without=q)
        assert ids.tolist() == order
        assert np.allclose(cosines, full[order])


def test_blocks_that_cannot_hold_a_nearest_example_are_left_out():
    """Four languages with words of their own and some in common; exact, also with the example itself left out."""
    r = np.random.default_rng(8)
    vectors = []
    for i in range(1500):
        own = 200 + 300 * (i % 4) + r.choice(60, 30, replace=False)
        t = np.unique(np.concatenate([r.choice(40, 8), own]))
        vectors.append((t, toxicity.unit(r.random(len(t)) + 0.1)))
    vectors += vectors[:30]
    index = toxicity.Index(vectors, 1400)
    dense = np.zeros((len(vectors), 1400))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    asked = list(range(0, len(vectors), 11))
    left_out = 0
    for without in (None, asked):
        found = index.nearest_of([vectors[i] for i in asked], 15, without)
        left_out += index.left_out
        for i, (ids, cosines) in zip(asked, found):
            full = dense @ dense[i]
            order = [j for j in np.lexsort((np.arange(len(full)), -full.round(9))) if full[j] > 0 and not (without and j == i)][:15]
            assert ids.tolist() == order and np.allclose(cosines, full[order], atol=1e-12)
    assert left_out > 0


def test_isotonic_regression():
    places, values = toxicity.isotonic(np.array([1, 2, 3, 4, 4.0]), np.array([0, 1, 0, 1, 1.0]), np.ones(5))
    assert (np.diff(places) > 0).all() and (np.diff(values) >= 0).all()
    assert np.interp(4, places, values) == 1 and np.interp(2.5, places, values) == pytest.approx(0.5)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_and_no_documents_and_labels(spark, odd_docs, no_docs, module):
    some = spark.createDataFrame(
        [(5, 1, 1), (5, 1, 1), (7, 0, 0), (9, None, None), (None, 1, 1), (12, 0, 1), (11, 1, 0), (1, 1, 0), (3, 0, 1)],
        "doc_id bigint, quality int, toxic int",
    )
    for labels in (some, some.limit(0), some.where("quality = 1 AND toxic = 1")):
        model = module.fit(odd_docs, labels)
        rows = module.classify(odd_docs, model).collect()
        assert len(rows) == odd_docs.count()
        assert all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (5, 6)}) == 1  # equal texts
        assert module.classify(no_docs, model).collect() == []


def test_building_blocks_holds_few_copies_of_the_matrix():
    """Every worker builds them, beside its other tables."""
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(1024):
        t = np.sort(rng.choice(4000, 500, replace=False))
        vectors.append((t, toxicity.unit(rng.random(500) + 0.1)))
    index = toxicity.Index(vectors, 4000)
    tracemalloc.start()
    try:
        built = index._blocks()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 3.5 * built["blocks"].nbytes


def test_the_driver_builds_no_blocks(spark, monkeypatch):
    """Examples are calibrated in tasks; the shares are those of the examples one by one."""
    rows = [(i, f"{'nasty ugly' if i % 2 else 'fine calm'} word{i % 7} text{i % 11}", i % 2) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    with monkeypatch.context() as m:
        m.setattr(toxicity.Index, "_blocks", None)
        model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    shares = [model.shares([model.index.vector(i)], [i])[0][0] for i in range(model.index.size)]
    places, values = toxicity.isotonic(np.array(shares), model.labels, model.weights)
    assert model.index.size > 60
    assert places.tolist() == model.places.tolist() and values.tolist() == model.values.tolist()


def test_powers_of_a_large_vocabulary_are_few():
    """Every worker keeps them; they must not grow with all terms together."""
    letters = "abcdefghijklmnopqrst"
    words = ["".join(x) for x in itertools.islice(itertools.product(letters, repeat=5), 120_000)]
    vocabulary = {w: i for i, w in enumerate(words)}
    terms = toxicity.Terms(vocabulary)
    assert len(terms.powers.up) <= 1 << 17
    some = [0, 9_999, 10_000, 10_001, 119_999]
    assert [(t.tolist(), n.tolist()) for t, n in terms.counted([words[i] for i in some])] == [([i], [1]) for i in some]


def test_index_holds_narrow_numbers_and_finds_the_nearest():
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(300):
        t = np.flatnonzero(rng.random(400) < rng.choice([0.02, 0.3]))
        vectors.append((t, toxicity.unit(rng.random(len(t)))))
    index = toxicity.Index(vectors, 400)
    assert index.term.dtype == np.int32 and index._blocks()["places"].dtype == np.int32
    dense = np.zeros((300, 400))
    for row, (t, w) in zip(dense, vectors):
        row[t] = w
    found = index.nearest_of(vectors, 7, list(range(300)))
    for i, (ids, cosines) in enumerate(found):
        own = dense @ dense[i]
        own[i] = -1
        want = [j for j in np.lexsort((np.arange(300), -own.round(9)))[:7] if own[j] > 0]
        assert ids.tolist() == want and np.allclose(cosines, own[want], rtol=1e-12)


def odd_words(seed, n):
    r = np.random.default_rng(seed)
    letters = ["a", "b", "z", "Q", "é", "É", "İ", "ß", "ǆ", "中", "テ", "😀", "1", "٣", "²", "_", "&", "Ⅷ", "ª", "̇", "\x85", "\xa0", " ", "\n", "."]
    return ["".join(r.choice(letters, r.integers(0, 40))) for _ in range(n)]


def test_terms_of_odd_words_are_those_of_the_strings(monkeypatch):
    """Also with few places for words, where later words take those of earlier ones."""
    texts = odd_words(1, 600)
    split = lambda text: re.split(r"[\x20\x09-\x0d.,;:!?]+", text.translate({c: c + 32 for c in range(65, 91)}))
    every = sorted({t for text in texts[::2] for w in split(text) for t in toxicity.terms_of(w)})
    vocabulary = {t: i for i, t in enumerate(every)}
    want = []
    for text in texts:
        found = [vocabulary[t] for w in split(text) for t in toxicity.terms_of(w) if t in vocabulary]
        want.append(sorted(collections.Counter(found).items()))
    for places in (toxicity.KEPT_WORDS, 32):
        monkeypatch.setattr(toxicity, "KEPT_WORDS", places)
        terms = toxicity.Terms(vocabulary)
        for _ in range(2):
            found = [x for a in range(0, 600, 150) for x in terms.counted(texts[a : a + 150])]
            assert [list(zip(t.tolist(), n.tolist())) for t, n in found] == want


def test_terms_of_a_word_are_looked_up_once(monkeypatch):
    terms = toxicity.Terms({"some": 0, "some*": 1, "word": 2, "word*": 3, "words": 4, "words*": 5})
    asked = []
    look = toxicity.Terms._of_words
    monkeypatch.setattr(toxicity.Terms, "_of_words", lambda self, data, words, first: asked.append(len(first)) or look(self, data, words, first))
    once = terms.counted(["some words", "other words, (some)"])
    again = terms.counted(["words some", "(some) words other"])
    assert asked == [4]
    assert [(t.tolist(), n.tolist()) for t, n in once] == [(t.tolist(), n.tolist()) for t, n in again]


def test_workers_get_no_strings_of_the_vocabulary(spark):
    """Workers of several stages wait beside each other, each with what was broadcast to it."""
    rows = [(i, f"{'nasty ugly' if i % 2 else 'fine calm'} word{i % 7} text{i % 11} zebrafinch", i % 2) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    sent = pickle.dumps(model)
    assert "zebrafinch" in model.vocabulary and b"zebrafinch" not in sent
    texts = [t for _, t, _ in rows] + ["nasty", "calm zebrafinches", "", "(ugly) 123"]
    assert pickle.loads(sent).score(texts, {}) == model.score(texts, {})


def test_blocks_that_were_given_up_are_built_again():
    rng = np.random.default_rng(2)
    vectors = [(t, toxicity.unit(rng.random(len(t)) + 0.1)) for t in (np.sort(rng.choice(90, 12, replace=False)) for _ in range(200))]
    index = toxicity.Index(vectors, 90)
    found = index.nearest_of(vectors, 5)
    index.release()
    assert index._built is None
    for (ids, cosines), (more, same) in zip(found, index.nearest_of(vectors, 5)):
        assert ids.tolist() == more.tolist() and cosines.tolist() == same.tolist()
