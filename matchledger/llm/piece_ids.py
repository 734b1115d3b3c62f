"""SentencePiece ids of whole texts, by a table of distinct words.

A BPE model whose pieces hold the whitespace marker only at their beginning never merges across the place where a
marker follows another character. So a normalised text is cut there into marked words (`▁▁word`), and the ids of a
text are those of its words, one after the other. Texts come in slices: Arrow cuts a slice's texts in one go (a word is
a range of its bytes) and numbers the distinct words; the library segments each distinct word once, with a copy of the
model that does not normalise; numpy joins the ids back by position. A model without that property is refused.

The table is one of each slice, in the task that holds its texts: nothing is shuffled, and a slice holds the common
words many times. (One table for a whole corpus would shuffle a row for each word of each slice: over 30 million for
0.8 billion characters, more than the texts themselves, to save segmentation, which is a small share of the work.)

decode() is the library's, on all ids of a text, so what it gives is what the library gives.

Defined results: a null text is empty; an empty text has the end id alone (no ids if none is asked for); repeated rows
and rows without an id are encoded like any; an empty table gives an empty one. A text of any length is encoded whole:
one that is longer than a slice is cut between words. Further columns are carried along if named.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchledger.llm.common import slices

MARK = "▁"
#: Characters whose words share a table.
SLICE = 1 << 22
_MARK_BYTES = np.frombuffer(MARK.encode(), np.uint8)


class WordEncoder:
    """Encodes and decodes exactly as the library does with the model."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(path, "rb") as f:
            model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        if model.trainer_spec.model_type != 2 or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model is no BPE with markers before words")
        crossing = [p.piece for p in model.pieces if MARK in p.piece.lstrip(MARK)]
        if crossing:
            raise ValueError(f"pieces cross whitespace markers: {crossing[:3]}")
        if not model.trainer_spec.byte_fallback:
            raise ValueError("unknown characters of neighbouring words would become one piece: byte fallback is needed")
        self.library = SentencePieceProcessor(model_proto=model.SerializeToString())
        plain = model.normalizer_spec
        plain.Clear()
        plain.name, plain.add_dummy_prefix, plain.remove_extra_whitespaces, plain.escape_whitespaces = "identity", False, False, True
        self.words = SentencePieceProcessor(model_proto=model.SerializeToString())
        self.end = self.library.eos_id()

    def cut(self, texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
        """(the marked words of normalised texts, the first word of each text and one more)."""
        joined = pa.array(texts, pa.large_string())
        sizes = pc.binary_length(joined).to_numpy()
        at = np.concatenate(([0], np.cumsum(sizes)))  # where each text begins
        data = "".join(texts).encode()
        raw = np.frombuffer(data, np.uint8)
        is_mark = np.zeros(len(raw), bool)
        if len(raw) >= 3:
            is_mark[:-2] = (raw[:-2] == _MARK_BYTES[0]) & (raw[1:-1] == _MARK_BYTES[1]) & (raw[2:] == _MARK_BYTES[2])
        begins = is_mark.copy()
        begins[3:] &= ~is_mark[:-3]  # not behind another marker
        begins[at[:-1][sizes > 0]] = True
        starts = np.flatnonzero(begins)
        offsets = np.append(starts, len(raw)).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
        return words, np.searchsorted(starts, at)

    def table(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(the ids of all distinct words, the first of each word and one more, of each position the number of its word)."""
        numbered = words.dictionary_encode()
        of = self.words.encode(numbered.dictionary.to_pylist()) if len(words) else []
        first = np.concatenate(([0], np.cumsum(np.fromiter(map(len, of), np.int64, len(of)))))
        return np.fromiter((i for ids in of for i in ids), np.int32, first[-1]), first, numbered.indices.to_numpy()

    def encode(self, texts: list[str], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts, the first of each text and one more)."""
        words, first_word = self.cut(self.library.normalize(texts))
        ids, first, number = self.table(words)
        size = np.diff(first)[number]
        till = np.concatenate(([0], np.cumsum(size)))
        flat = ids[np.repeat(first[number] - till[:-1], size) + np.arange(till[-1])]
        edge = till[first_word]
        if not end:
            return flat, edge
        return np.insert(flat, edge[1:], self.end).astype(np.int32), edge + np.arange(len(edge))

    def encode_long(self, text: str, end: bool) -> np.ndarray:
        """The ids of a text longer than a slice, some words at a time."""
        words, _ = self.cut(self.library.normalize([text]))
        parts, i, bytes_to = [], 0, np.frombuffer(words.buffers()[1], np.int64)
        while i < len(words):
            j = max(i + 1, int(np.searchsorted(bytes_to, bytes_to[i] + SLICE)))
            ids, first, number = self.table(words[i:j])
            size = np.diff(first)[number]
            till = np.cumsum(size)
            parts.append(ids[np.repeat(first[number] - (till - size), size) + np.arange(till[-1])])
            i = j
        return np.concatenate([*parts, np.array([self.end] if end else [], np.int32)])


_encoders: dict[str, WordEncoder] = {}
_lock = threading.Lock()


def encoder(path: str) -> WordEncoder:
    """One for each model file and Python worker."""
    with _lock:
        if path not in _encoders:
            _encoders[path] = WordEncoder(path)
    return _encoders[path]


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", end: bool = True, to: str = "ids") -> DataFrame:
    """(key, ids array<int>) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in slices(texts, SLICE):
                if len(texts[i]) > SLICE:
                    ids = own.encode_long(texts[i], end)
                    edge = np.array([0, len(ids)])
                else:
                    ids, edge = own.encode(texts[i:j], end)
                lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), lists], [key, to])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.coalesce(text, F.lit("")).alias("__text")).mapInArrow(run, f"`{key}` {kind}, {to} array<int>")


def decode(rows: DataFrame, model: str, key: str = "doc_id", ids: str = "ids", to: str = "text") -> DataFrame:
    """rows (key, ids) with the text that the library decodes; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for b in batches:
            lists = b.column(1)
            sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            i = 0
            while i < len(lists):  # a slice of the ids at a time, or one text
                j = max(i + 1, i + int(np.searchsorted(np.cumsum(sizes[i:]), SLICE // 8)))
                part = lists.slice(i, j - i)
                told = [None if x is None else own.library.decode(x) for x in part.to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), part, pa.array(told, pa.string())], [key, ids, to])
                i = j

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, ids).mapInArrow(run, f"`{key}` {kind}, {ids} array<int>, {to} string")
