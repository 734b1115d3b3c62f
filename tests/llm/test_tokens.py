from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from matchledger.llm import tokens
from matchledger.llm.queries import token_table

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@given(st.lists(st.integers(0, 2**31 - 1) | st.integers(0, 40), max_size=3000), st.sampled_from([0.5, 0.9, 1.0]))
@settings(max_examples=40, deadline=None)
def test_blocks_round_trip(ids, percentile):
    row = tokens.pack(np.array(ids, np.int64), percentile)
    assert tokens.unpack(row, len(ids)).tolist() == ids


def test_outliers_are_exceptions():
    ids = np.array([5] * 900 + [10**6] + [6] * 123)
    row = tokens.pack(ids, 0.95)
    assert row["width"] == [1] and len(row["exc_at"]) == 2 and len(row["packed"]) == 128


@given(st.lists(st.text(alphabet=" ab\n\t.,'é1\x1c\xa0<|endoftext|>", max_size=30), max_size=4))
@settings(max_examples=150, deadline=None)
def test_chunks_encode_as_whole_texts(texts):
    enc = tokens.encoder(PATH)
    texts += ["x <|endoftext|> y", "  two  spaces ", "it's\n \n'll"]
    assert [np.frombuffer(b, "<u4").tolist() for b in enc(texts)] == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def check(got, rows, tokenizer):
    start = 0
    got = {r["doc_id"]: r for r in got.collect()}
    for k, t in sorted(rows):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        assert got[k].asDict() == {"doc_id": k, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(ids, "<u4").tobytes())}
        start += len(ids)
    assert len(got) == len(rows)


def test_files_round_trip(spark, docs, tokenizer):
    rows = [(9, "hello  world"), (1, None), (4, ""), (3, "wörd " * 20000), (-2, "a\nb")]
    check(token_table(spark, docs(rows)), rows, tokenizer)
    assert token_table(spark, docs([])).count() == 0
    assert token_table(spark, docs([(1, "x"), (1, "x"), (None, "y")])).count() == 3


def test_query_over_documents(spark, tokenizer):
    from matchledger.llm.queries import op8_token_ids

    d = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    check(op8_token_ids(spark, d), rows, tokenizer)
