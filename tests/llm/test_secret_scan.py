import hashlib
import itertools
import re

import numpy as np
import pytest

from brickrow.llm import secret_scan as scan
from brickrow.llm.queries import op3_secret_scan, secret_digests

SF = "/root/testdata/sf0.01"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def brute_base(text):
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda x: (x[1], ["assign", "access", "hex"].index(x[0])))


CASES = [
    "",
    "password=hunter2",
    "PassWord : 'abcdef' Api_Key=\"zzzzzz\"",
    "secret:token :abcdef123",  # the failing first match takes the second key word with it
    "token=token=abcdef",
    "password==abcdefg",
    "paſſword=abcdefg toKen=abcdefg",
    "x" + "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + " AKIAAKIA" + "C" * 14,
    "0123456789abcdef01234567 0123456789ABCDEF01234567 " + "f" * 23,
    "é😀 token = \"0123456789abcdef0123456789abcdef\" é",
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_equal_brute_force(text):
    assert [(scan.KINDS[k], a, b) for k, a, b, _ in scan.base_spans(text)] == brute_base(text)


def test_spans_of_the_field_are_cut_at_base_spans():
    assert scan.beyond(3, 9, []) == scan.beyond(3, 9, [(0, 3), (9, 12)]) == [(3, 9)]
    assert scan.beyond(0, 30, [(4, 8), (12, 20)]) == [(8, 12), (20, 30)]
    assert scan.beyond(6, 10, [(4, 12)]) == [] and scan.beyond(6, 15, [(4, 12)]) == [(12, 15)]
    assert scan.beyond(0, 20, [(2, 15), (4, 6), (8, 9)]) == [(15, 20)]


@pytest.fixture(scope="module")
def field(spark):
    return scan.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_decoding_equals_trying_all_paths(field):
    r = np.random.default_rng(1)
    for steps in (field.steps, r.normal(0, 1.5, (3, 3))):
        own = scan.Field(field.weights, steps, True)
        for _ in range(60):
            n = int(r.integers(1, 8))
            scores = r.normal(0, 3, (n, 3)) + np.array([r.choice([0, 4, 12]), 0, 0])
            cuts = np.sort(r.integers(0, 3, n))
            got = own.decode(scores, cuts)
            for text in set(cuts.tolist()):
                at = np.flatnonzero(cuts == text)

                def total(path):
                    return sum(scores[i, s] for i, s in zip(at, path)) + sum(steps[a, b] for a, b in zip(path, path[1:]))

                best = max(itertools.product(range(3), repeat=len(at)), key=total)
                assert total(tuple(got[at])) == pytest.approx(total(best))


def test_a_text_is_decoded_alike_alone_and_among_others(field):
    texts = ["password = hunter22 x", "", "call 555-1234", "key a1B2c3D4e5F6g7H8i9J0 end", "é token: zzz999zzz é"]
    together = scan.found(texts, field)
    assert together == [scan.found([t], field)[0] for t in texts]


def test_the_field_finds_secrets_it_has_not_seen(spark, field):
    """Tokens of base spans in other documents, told by the field alone."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id >= 1000 AND doc_id < 4000").select("text")
    hit = total = wrong = tokens_ = 0
    for (text,) in docs.collect():
        tokens = scan.Tokens([text.encode()])
        if not len(tokens.start):
            continue
        spans = [(len(text[: x[3]].encode()), len(text[: x[2]].encode())) for x in scan.base_spans(text)]
        want = scan.label(tokens, spans) > 0
        got = field.decode(field.scores(tokens.features), tokens.text) > 0
        hit, total = hit + int((want & got).sum()), total + int(want.sum())
        wrong, tokens_ = wrong + int((got & ~want).sum()), tokens_ + len(want)
    assert total > 30 and hit >= 0.6 * total and wrong <= 1e-4 * tokens_


def test_query_digests(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op3_secret_scan(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute_base(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in base) for x in ("assign", "access", "hex"))
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert [s for s in spans if s[0] != "crf"] == base and spans == sorted(spans, key=lambda s: s[1])


def test_odd_documents(odd_docs, field):
    rows = secret_digests(scan.scan(odd_docs, field)).collect()
    assert len(rows) == odd_docs.count()
    assert sum(r.n_assign for r in rows) == 1 and sum(r.n_access for r in rows) == 1 and sum(r.n_hex for r in rows) == 1
    clean = scan.redact(odd_docs, field)
    assert clean.columns == odd_docs.columns
    changed = [r.text for r in clean.collect() if r.text and "[SECRET]" in r.text]
    assert changed == ['password = "[SECRET]" and [SECRET]\n\n[SECRET]']
    assert clean.where("text is null").count() == odd_docs.where("text is null").count()


def test_nothing_to_learn_from(no_docs):
    field = scan.fit(no_docs)
    assert not field.learned
    assert scan.scan(no_docs, field).collect() == []
    assert [x[:3] for x in scan.found(["token=abcdef"], field)[0]] == [(0, 0, 12)]
