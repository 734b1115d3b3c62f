"""Batches in pieces, and encoding with and without what earlier tasks have left."""

import numpy as np
import pyarrow as pa
import public_tokenizers

from matchledger.llm import tokens
from matchledger.llm.common import Words, pieces, release


def test_pieces_hold_every_row_once_and_keep_to_the_bound():
    texts = ["", None, "x" * 500, *("y" * n for n in range(60)), "z" * 70]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    got = list(pieces(batch, 200))
    assert pa.Table.from_batches(got).to_pydict() == batch.to_pydict()
    assert len(got) > 10 and all(p.num_rows == 1 or p.nbytes <= 200 for p in got)
    assert [p.num_rows for p in pieces(batch.slice(0, 0), 200)] == [0]


def test_words_are_the_same_after_memory_was_given_back():
    texts = [["a b"], ["one two three " * 4000], ["", "b a"]]
    first = [Words(t).hash for t in texts]
    release()
    for t, h in zip(reversed(texts), reversed(first), strict=True):
        assert np.array_equal(Words(t).hash, h)
    assert Words(["b", "x b"]).hash[0] == Words(["a b"]).hash[1]


def test_ids_are_the_same_after_chunks_were_forgotten():
    encode = tokens.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"), 100)
    texts = ["A first text, with words. And words!", "", "  two  spaces", "words again"]
    before = encode(texts)
    encode.forget()
    assert encode(texts) == before
