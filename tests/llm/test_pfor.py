"""Token-id store: exact round trips."""

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import pfor


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60), st.integers(0, 50_000), st.integers(0, 2**32 - 1)), max_size=700))
def test_round_trip(ids):
    x = np.array(ids, np.uint32)
    data = pfor.pack(x)
    assert pfor.unpack(data).tolist() == ids
    if len(ids) > 128:  # through the block index
        assert pfor.unpack(data, 1, 2).tolist() == ids[128:256]


def test_outliers_are_exceptions():
    x = np.arange(128, dtype=np.uint32) % 8
    x[5] = 4_000_000_000
    assert len(pfor.pack(x)) == 12 + 4 + 6 + 3 * 16 + 5


@pytest.fixture(scope="module")
def tokenizer():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(pfor.tokenizer_path())


def encoded(texts, path=None):
    ids, sizes = pfor.encoder(path or pfor.tokenizer_path())(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []


def test_other_tokenizer_encodes_whole_texts():
    """A file whose ids of a text aren't those of its words takes the plain way."""
    from tokenizers import Tokenizer

    path = pfor.tokenizer_path("byte_bpe_50k.json")
    texts = ["Two  words", "", "a <|endoftext|> b\n", "é中"]
    assert encoded(texts, path) == [Tokenizer.from_file(path).encode(x, add_special_tokens=False).ids for x in texts]


def test_the_bound_of_what_is_remembered():
    words = pfor.Words(limit=500)
    words.add([b"a", b"bc", b"d"], np.array([1, 2, 1]), np.array([5, 6, 7, 8], np.uint32))
    assert words.used == 4 + 3 * pfor.ENTRY_BYTES + 16
    words.came(np.array([1, 2]))
    words.came(np.array([1]))
    words.shrink()  # one word came again
    assert words.number == {b"bc": 0} and [x.tolist() for x in words.tables()] == [[0], [2], [6, 7]]
    words.limit = 10
    words.shrink()
    assert not words.number and not words.used


WORDS = st.text(alphabet=st.sampled_from("aBé'st.,!?;: \t\n\x0b\x1c\xa0\u0301İKſ\u0958я\u03a3\u1e9e19<|>_-#$%&*()/中"), max_size=40)


@settings(max_examples=100, deadline=None)
@given(st.lists(WORDS, max_size=4))
def test_words_encode_like_whole_texts(texts):
    from tokenizers import Tokenizer

    t = test_words_encode_like_whole_texts.__dict__.setdefault("t", Tokenizer.from_file(pfor.tokenizer_path()))
    assert encoded(texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_special_strings(tokenizer):
    texts = ["a <|endoftext|> b", "<|endoftext|>.", "<|ENDOFTEXT|>", "x<|startoftext|>y."]
    assert encoded(texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def expected(tokenizer, rows):
    at, out = 0, []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def test_query_equals_brute_force(spark, tiny, tokenizer):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in pfor.query(spark, tiny).collect())
    assert got == expected(tokenizer, docs)


def test_odd_rows(spark, tokenizer):
    rows = [(3, None), (1, ""), (2, "Long words " * 40_000), (5, "same"), (5, "same"), (None, "first")]
    df = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, shard int")
    got = [tuple(r)[:4] for r in pfor.encoded(df, pfor.tokenizer_path()).collect()]
    want = expected(tokenizer, sorted(rows, key=lambda r: -1 if r[0] is None else r[0]))
    assert sorted(got, key=lambda r: r[1]) == want
    assert pfor.encoded(df.limit(0), pfor.tokenizer_path()).count() == 0
