import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from brickrow.llm import token_store
from brickrow.llm.encoding import WordEncoder
from brickrow.llm.queries import TOKENIZER, op1_token_store

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def plain(library, text, end=(0,)):
    return [*library.encode(text or "", add_special_tokens=False).ids, *end]


@given(st.lists(st.integers(0, 2**31), max_size=1200))
@settings(max_examples=60, deadline=None)
def test_codes_round_trip_and_direct_access(ids):
    data = token_store.build(np.array(ids, np.uint32))
    assert token_store.decode(data).tolist() == ids
    for i in range(0, len(ids), 37):
        assert token_store.access(data, i) == ids[i]


def test_access_across_blocks_and_beyond():
    ids = (np.random.default_rng(1).integers(0, 50257, 5000) >> np.random.default_rng(2).integers(0, 16, 5000)).astype(np.uint32)
    data = token_store.build(ids)
    assert [token_store.access(data, i) for i in range(5000)] == ids.tolist()
    with pytest.raises(IndexError):
        token_store.access(data, 5000)
    assert token_store.widths(np.zeros(0, np.uint32)) == [1]


@given(st.lists(st.text(alphabet="ab, '1é\n\t  　\xa0\x1c\x85!s<|>.", max_size=30), min_size=1, max_size=20))
@settings(max_examples=150, deadline=None)
def test_words_encode_like_whole_texts(library, texts):
    words = WordEncoder(TOKENIZER, kept=50)
    for _ in range(2):  # the second time from the store
        got = [np.frombuffer(x, "<u4").tolist() for x in words.encode([t.encode() for t in texts])]
        assert got == [plain(library, t, ()) for t in texts]


def expected(library, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for doc_id, text in rows:
        ids = plain(library, text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_documents_read_back_equal_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in op1_token_store(spark, SF).collect())
    assert got == expected(library, [tuple(r) for r in docs])


def test_odd_documents(spark, odd_docs, library, tmp_path):
    path = token_store.write(odd_docs, str(tmp_path / "t"), TOKENIZER)
    rows = token_store.documents(spark, path).orderBy("start").collect()
    texts = odd_docs.select("doc_id", "text").collect()
    whole = [i for r in rows for i in np.frombuffer(r.ids, "<u4").tolist()]
    assert [r.doc_id for r in rows] == sorted([t.doc_id for t in texts], key=lambda x: (x is not None, x or 0))
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in rows) == sorted(plain(library, t.text) for t in texts)
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    for position in (0, 1, len(whole) // 2, len(whole) - 1):
        assert token_store.token(spark, path, position) == whole[position]
    assert token_store.token(spark, path, len(whole)) is None


def test_no_documents(spark, no_docs, tmp_path):
    path = token_store.write(no_docs, str(tmp_path / "t"), TOKENIZER)
    assert token_store.documents(spark, path).collect() == []
