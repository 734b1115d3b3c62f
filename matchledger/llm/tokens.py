"""Token ids as patched frame-of-reference blocks.

write() tokenises whole texts and stores them, in ascending order of ids, as rows of Parquet files. A row is a
segment of whole documents (about `segment` token ids, more only for a single long document), so it can be decoded by
itself, wherever and in whatever order rows are read. Inside, ids are cut into blocks of 1024: a block's minimum is
subtracted, the width is the one that holds the given percentile of the differences, differences are packed at that
width, and what does not fit (the outliers) stands in an exception list with its position. The row also holds where
each block's bytes start, so that one block can be decoded alone. read() decodes the files.

Columns of a row: shard int, segment int, first long (token ids of the shard before this row), doc_ids array<id>,
doc_n array<int> (token ids of each document), low array<int>, width array<tinyint>, start array<int> (of each
block in `packed`, in bytes), packed binary, exc_start array<int> (of each block in the exception lists), exc_at
binary (uint16 positions in the block), exc_value binary (uint32 differences). All numbers are little-endian.

Defined results: a null text counts as empty and has the end id alone; null ids come first; rows with equal ids are
separate documents in the order of a hash of their texts; an empty table gives an empty one.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchledger.llm.common import PIECE, map_arrow, pieces, release, slices

BLOCK = 1024
#: Token ids of a text, before the end id.
Encoder = Callable[[list[str]], list[bytes]]


#: Chunks that a worker remembers, about 200 bytes each.
KEEP = 1_600_000


class ChunkEncoder:
    """Encodes with the tokenizers library, each distinct chunk of a text once.

    A byte-level BPE with the usual pattern never has a token across a space that a non-space follows, so texts are
    cut there and the ids of the chunks are joined: Arrow cuts many texts at once and numbers their distinct chunks,
    and numpy lines up the ids. The same pattern never joins a letter to punctuation after it, so a chunk of ASCII
    letters and one mark at its end is two. A text that holds one of the tokenizer's added tokens is encoded as a whole."""

    def __init__(self, path: str, keep: int = KEEP):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocab.values()) + 1, bool)
        self.spaced[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True  # a space in the vocabulary's alphabet
        self.keep, self.later, self.older = keep // 2, {}, {}
        self.mark = {m: self._one(m) for m in MARKS}

    def forget(self) -> None:
        """All chunks, but not the tokenizer."""
        self.later, self.older = {}, {}

    def _learn(self, chunks: list[str]) -> None:
        """The ids of these chunks, each with a space before it. Many are encoded as one text: of their tokens, those that begin with a space begin a chunk."""
        if len(self.later) > self.keep:  # chunks that are used again come back from the older ones
            self.older, self.later = self.later, {}
        later, older = self.later, self.older
        missing = [c for c in chunks if c not in later]
        if older:
            later.update((c, older[c]) for c in missing if c in older)
            missing = [c for c in missing if c not in older]
        plain = [c for c in missing if " " not in c]
        for i in range(0, len(plain), 2000):
            part = plain[i : i + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, "<u4")  # without offsets
            begin = np.flatnonzero(self.spaced[ids])
            if len(begin) == len(part):
                raw, at = ids.tobytes(), [*(4 * begin).tolist(), 4 * len(ids)]
                later.update(zip(part, (raw[s:e] for s, e in zip(at, at[1:])), strict=True))  # noqa: B905
        later.update((c, self._one(" " + c)) for c in missing if c not in later)

    def _one(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _of(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks."""
        stem = [c[:-1] if c[-1:] in MARKS and c[:-1].isascii() and c[:-1].isalpha() else c for c in chunks]
        self._learn(list(set(stem)))
        later, mark = self.later, self.mark
        return [later[x] if x is c else later[x] + mark[c[-1]] for x, c in zip(stem, chunks, strict=True)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        whole = [any(a in t for a in self.added) for t in texts]
        cut = [EDGE.split(t) if INNER.search(t) and not w else None for t, w in zip(texts, whole, strict=True)]
        even = [k for k, (c, w) in enumerate(zip(cut, whole, strict=True)) if c is None and not w]
        out: list[bytes] = [b""] * len(texts)
        lists = pc.split_pattern(pa.array([texts[k] for k in even], pa.large_string()), " ")
        first = lists.offsets.to_numpy()
        numbered = lists.values.dictionary_encode()
        chunks = numbered.dictionary.to_pylist()
        heads = lists.values.take(pa.array(first[:-1])).to_pylist()  # without a space before them
        table = self._of(chunks) + [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(heads, add_special_tokens=False)]
        of_word = numbered.indices.to_numpy().copy()
        of_word[first[:-1]] = len(chunks) + np.arange(len(heads))
        size = np.fromiter(map(len, table), np.int32, len(table)) // 4
        begin = np.cumsum(size, dtype=np.int32) - size
        count = size[of_word]
        end = np.cumsum(count, dtype=np.int64)
        at = np.repeat(begin[of_word] - (end - count), count) + np.arange(end[-1] if len(end) else 0)
        raw = np.frombuffer(b"".join(table), "<u4")[at].tobytes()
        edge = (4 * np.concatenate(([0], end))[first]).tolist()
        for k, s, e in zip(even, edge, edge[1:], strict=False):
            out[k] = raw[s:e]
        for k, c in enumerate(cut):
            if whole[k]:
                out[k] = self._one(texts[k])
            elif c is not None:
                out[k] = (self._one(c[0]) if c[0] else b"") + b"".join(self._of(c[1:]))
        return out


#: Marks that stand by themselves after letters. (An apostrophe may begin a token with letters.)
MARKS = frozenset(".,;:!?)\"")
EDGE = re.compile(r" (?=\S)")
INNER = re.compile(r" (?!\S)")  # a space at which a text is not cut

_encoders: dict[tuple[str, int], ChunkEncoder] = {}


def encoder(path: str, keep: int = KEEP) -> Encoder:
    """One for each tokenizer file and Python worker."""
    if (path, keep) not in _encoders:
        _encoders[path, keep] = ChunkEncoder(path, keep)
    return _encoders[path, keep]


def pack(ids: np.ndarray, percentile: float) -> dict:
    """The columns low .. exc_value of a segment."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    size = np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    full = np.concatenate((ids, np.full(blocks * BLOCK - n, ids[-1] if n else 0))).astype(np.int64).reshape(-1, BLOCK)
    low = full.min(axis=1) if blocks else np.zeros(0, np.int64)
    diff = full - low[:, None]
    bits = np.frexp(diff.astype(np.float64))[1]  # width of each difference
    rank = np.minimum(np.ceil(BLOCK * percentile).astype(int), BLOCK) - 1
    width = np.partition(bits, rank, axis=1)[:, rank] if blocks else np.zeros(0, np.int64)
    over = bits > width[:, None]
    over.reshape(-1)[n:] = False
    at_block, at = np.nonzero(over)
    part: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        which = np.flatnonzero(width == w)
        spread = ((diff[which][:, :, None] >> np.arange(w)) & 1).astype(np.uint8).reshape(len(which), -1)
        for k, row in zip(which, np.packbits(spread, axis=1, bitorder="little"), strict=True):
            part[k] = row[: (int(size[k]) * int(w) + 7) // 8].tobytes()
    return {
        "low": low.tolist(),
        "width": width.tolist(),
        "start": np.concatenate(([0], np.cumsum([len(p) for p in part])[:-1])).astype(int).tolist() if blocks else [],
        "packed": b"".join(part),
        "exc_start": np.searchsorted(at_block, np.arange(blocks)).tolist(),
        "exc_at": at.astype("<u2").tobytes(),
        "exc_value": diff[at_block, at].astype("<u4").tobytes(),
    }


def unpack(row: dict, n: int) -> np.ndarray:
    """All token ids of a segment."""
    out = np.zeros((-(-n // BLOCK), BLOCK), np.int64)
    packed = np.frombuffer(row["packed"], np.uint8)
    low, width, start = np.array(row["low"], np.int64), np.array(row["width"], np.int64), np.array([*row["start"], len(packed)], np.int64)
    for w in np.unique(width[width > 0]):
        which = np.flatnonzero(width == w)
        raw = np.zeros((len(which), BLOCK * w // 8), np.uint8)
        for i, k in enumerate(which):
            raw[i, : start[k + 1] - start[k]] = packed[start[k] : start[k + 1]]
        bit = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(which), BLOCK, w)
        value = np.zeros((len(which), BLOCK), np.int64)
        for b in range(w):
            value |= bit[:, :, b].astype(np.int64) << b
        out[which] = value
    at = np.frombuffer(row["exc_at"], "<u2").astype(np.int64)
    block = np.repeat(np.arange(len(low)), np.diff([*row["exc_start"], len(at)]))
    out[block, at] = np.frombuffer(row["exc_value"], "<u4")
    return (out + low[:, None]).reshape(-1)[:n]


_FORMAT = "shard int, segment int, first long, doc_ids array<{id}>, doc_n array<int>, low array<int>, width array<tinyint>, start array<int>, packed binary, exc_start array<int>, exc_at binary, exc_value binary"


def write(docs: DataFrame, path: str, encode_with: str, id_col: str = "doc_id", text: str = "text", end_id: int = 0, percentile: float = 0.95, segment: int = 1 << 16, shards: int | None = None, keep: int = KEEP, between: bool = True) -> None:
    """encode_with: the path of the tokenizer's file on every machine. keep: chunks that a worker remembers, between: also
    from one task to its next (both change its memory and speed, not what is written). shards: range partitions by id, by default spark.sql.shuffle.partitions."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(shards or int(spark.conf.get("spark.sql.shuffle.partitions")), "id").sortWithinPartitions("id", F.xxhash64("text"))
    end = np.array([end_id], "<u4").tobytes()
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(encode_with, keep), TaskContext.get().partitionId()
        k, first, held_ids, held = 0, 0, [], []

        def flush(id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal k, first, held_ids, held
            ids = np.frombuffer(b"".join(held), "<u4")
            kinds = {"doc_ids": pa.list_(id_type), "doc_n": pa.list_(pa.int32()), "low": pa.list_(pa.int32()), "width": pa.list_(pa.int8()), "start": pa.list_(pa.int32()), "exc_start": pa.list_(pa.int32()), "shard": pa.int32(), "segment": pa.int32(), "first": pa.int64()}
            row = {"shard": shard, "segment": k, "first": first, "doc_ids": held_ids, "doc_n": [len(x) // 4 for x in held]} | pack(ids, percentile)
            k, first, held_ids, held = k + 1, first + len(ids), [], []
            return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(c, pa.binary())) for c, v in row.items()], list(row))

        size, id_type = 0, None
        for b in (x for whole in batches for x in (pieces(whole, PIECE) if not between else (whole,))):
            ids, texts, id_type = b.column("id").to_pylist(), b.column("text").to_pylist(), b.column("id").type
            for i, j in slices(texts, 1 << 22):
                for doc, got in zip(ids[i:j], encode(texts[i:j]), strict=True):
                    if held and size + len(got) // 4 + 1 > segment:
                        yield flush(id_type)
                        size = 0
                    held_ids.append(doc)
                    held.append(got + end)
                    size += len(got) // 4 + 1
        if held:
            yield flush(id_type)
        if not between:
            encode.forget()
            release()

    ordered.mapInArrow(run, _FORMAT.format(id=kind)).write.parquet(path)


def read(spark: SparkSession, path: str, of_doc: Callable[[np.ndarray], dict], schema: str) -> DataFrame:
    """(id, start, n_tokens, and what of_doc makes of each document's ids, as in schema). start: token ids of all documents before it."""
    rows = spark.read.parquet(path)
    totals = rows.groupBy("shard").agg(F.max(F.col("first") + F.aggregate("doc_n", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    # a row for each shard; their sums are small, so one task may add them up
    base = totals.select("shard", (F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("base"))
    placed = rows.join(F.broadcast(base), "shard").withColumn("first", F.col("first") + F.col("base")).drop("base", "shard", "segment")
    kind = dict(rows.dtypes)["doc_ids"][len("array<") : -1]
    names = [x.strip().split()[0] for x in schema.split(",")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got: dict[str, list] = {c: [] for c in ("id", "start", "n_tokens", *names)}
        for row in batch.to_pylist():
            n = np.array(row["doc_n"], np.int64)
            ids = unpack(row, int(n.sum())).astype("<u4")
            at = np.concatenate(([0], np.cumsum(n)))
            got["id"] += row["doc_ids"]
            got["start"] += (row["first"] + at[:-1]).tolist()
            got["n_tokens"] += n.tolist()
            for i, j in zip(at[:-1], at[1:], strict=True):
                for c, v in of_doc(ids[i:j]).items():
                    got[c].append(v)
        return pa.RecordBatch.from_arrays([pa.array(v, batch.column("doc_ids").type.value_type if c == "id" else None) for c, v in got.items()], list(got))

    return map_arrow(placed, run, f"id {kind}, start long, n_tokens long, {schema}")


def crc32(ids: np.ndarray) -> dict:
    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}
