"""Ids and decoded texts against the library's own, on whole tables and odd texts."""

from __future__ import annotations

import random
from hashlib import sha256

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from matchledger.llm import piece_ids, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "   ", "a", "▁", "▁▁x ▁ y▁", "\t\n a\r\n\x0b", "<s> </s> <unk> <0x0A> <pad>", "\x00a\x00 b", "é́ 日本語 テスト 🎉🎉  x", " " * 40 + "x" + " " * 33,
    "a b　c d", "𝒳 � ﻿ ​", "1234 5,6.7  8", "x" * 3000, "l'été  c'est", "ab " * 5000, "𐍈" * 50, "a" + "́" * 20,
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def told(library, key, text):
    ids = library.encode(text or "", add_eos=True)
    h = lambda x: sha256(x.encode()).hexdigest()
    return key, len(ids), h(" ".join(map(str, ids))), h(library.decode(ids))


def test_query_equals_the_library(spark, library):
    d = "/root/testdata/sf0.01"
    want = [told(library, r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op13_sentencepiece(spark, d).collect())) == sorted(want)


@pytest.mark.parametrize("slice_", [1, 7, 1 << 23])
def test_odd_texts_in_slices_of_any_size(library, monkeypatch, slice_):
    monkeypatch.setattr(piece_ids, "SLICE", slice_)
    own = piece_ids.encoder(MODEL)
    ids, edge = own.encode(ODD)
    want = [library.encode(t, add_eos=True) for t in ODD]
    assert [ids[s:e].tolist() for s, e in zip(edge, edge[1:])] == want
    assert [own.encode_long(t, True).tolist() for t in ODD] == want
    assert own.encode_long("", False).tolist() == [] and own.encode([], True)[0].tolist() == []


def test_random_texts(library):
    rnd, own = random.Random(4), piece_ids.encoder(MODEL)
    marks = [" ", "  ", "▁", "\n", "a", "The", "ing", "é", "é", "中", "🎉", "0", "12", ".", "'s", "\x00", "\x7f", "Ω"]
    texts = ["".join(rnd.choice(marks) for _ in range(rnd.randrange(40))) for _ in range(4000)]
    ids, edge = own.encode(texts, end=False)
    assert [ids[s:e].tolist() for s, e in zip(edge, edge[1:])] == library.encode(texts)


def test_rows_nulls_repeats_and_clashing_names(spark, library):
    rows = [*((i, t, 1) for i, t in enumerate(ODD)), (None, None, 2), (3, "a", 3), (3, "a", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = piece_ids.decode(piece_ids.encode(docs, MODEL), MODEL).collect()
    want = [(k, library.encode(t or "", add_eos=True)) for k, t, _ in rows]
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r["text"] == library.decode(r["ids"]) for r in got)
    assert piece_ids.encode(docs.limit(0), MODEL).count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert piece_ids.decode(none, MODEL).collect()[0]["text"] is None


def test_models_with_crossing_pieces_are_refused(tmp_path):
    model = sentencepiece_model_pb2.ModelProto.FromString(open(MODEL, "rb").read())
    model.pieces[5000].piece = "of▁the"
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="cross"):
        piece_ids.WordEncoder(str(tmp_path / "m"))
