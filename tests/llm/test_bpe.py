import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from brickrow.llm import bpe
from brickrow.llm.queries import RANKS, op4_byte_bpe

PATTERN = public_tokenizers.PATTERN
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.Codec(bpe.read_ranks(RANKS), PATTERN)


def ids(library, text):
    return np.array(library.encode_ordinary(text), "<u4").tobytes()


def test_random_texts_equal_the_library(own, library):
    r = random.Random(5)
    alphabet = "abcdeth ion'sre 1é\n\t  　\x1c😀ß"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    got = own.encode(texts)
    assert got == [ids(library, t) for t in texts]
    assert own.decode(got) == [t.encode() for t in texts]


@pytest.mark.parametrize("text", [" " * 300, "a" * 5000, "ab" * 500, "the" * 300, "\n" * 700, "é" * 400, "x" * 257])
def test_long_pieces_equal_the_library(own, library, text):
    assert own.encode([text]) == [ids(library, text)]


def test_a_word_of_a_million_letters(own, library):
    """It does not run out of memory; whole runs of four are contracted as in a short one."""
    got = own.encode(["a" * 1_000_000])
    assert got == [ids(library, "a" * 4000) * 250]
    assert own.decode(got) == [b"a" * 1_000_000]


def test_long_random_pieces_equal_the_library(own, library):
    r = random.Random(6)
    for letters in ("abcdefghijklmnop", "abctheinr"):
        text = "".join(r.choice(letters) for _ in range(900))
        assert own.encode([text]) == [ids(library, text)]


def test_a_vocabulary_where_a_lesser_rank_follows():
    """'bc' (rank 260) lets 'abc' (rank 257) arise: occurrences must be contracted one at a time."""
    ranks = {bytes([i]): i for i in range(256)}
    ranks |= {b"ab": 300, b"abc": 257, b"abcb": 258, b"bc": 260}
    own = bpe.Codec(ranks, r"(?s).+")
    library = tiktoken.Encoding("x", pat_str=r"(?s).+", mergeable_ranks=dict(sorted(ranks.items(), key=lambda x: x[1])), special_tokens={})
    r = random.Random(7)
    for n in [3, 5, 8, 13, 300, 600]:
        text = "".join(r.choice("abc") for _ in range(n))
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_decode_rejects_unknown_ids(own):
    with pytest.raises(ValueError):
        own.decode([np.array([60000], "<u4").tobytes()])
    assert own.decode([b"", b""]) == [b"", b""]


def test_query_equals_the_library(spark, library):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in op4_byte_bpe(spark, SF).collect())
    want = []
    for r in texts:
        data = ids(library, r.text)
        want.append((r.doc_id, len(data) // 4, hashlib.sha256(data).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    assert got == sorted(want)


def test_odd_documents(odd_docs, library):
    encoded = bpe.encode(odd_docs, RANKS, PATTERN)
    got = sorted(bytes(r.ids) for r in encoded.collect())
    texts = [r.text or "" for r in odd_docs.collect()]
    assert got == sorted(ids(library, t) for t in texts)
    decoded = bpe.decode(encoded, RANKS, PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in decoded) == sorted(t.encode() for t in texts)


def test_no_documents(no_docs):
    assert bpe.round_trip(no_docs, RANKS, PATTERN).collect() == []


def test_decoding_needs_no_query(own, monkeypatch):
    """Bytes are taken from the vocabulary by id; a join and an ordered aggregation cost a fifth of the operator."""
    texts = ["two words", "", "naïve café 中文", "x" * 300]
    ids = own.encode(texts)
    monkeypatch.setattr(own, "_query", None)
    assert own.decode(ids) == [t.encode() for t in texts]
