"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

Each word shingle is hashed once: the top bits of the hash choose a bin, and a bin keeps its smallest remainder. An
empty bin copies a full one that a hash of (bin, attempt) chooses, attempt after attempt, so that all full bins are
equally likely (optimal densification). A fingerprint stores the low `bits` bits of each bin. Two unrelated bins
agree in these by chance with probability c = 2^-bits, so likeness is (share of equal bins - c) / (1 - c), not
below 0.

Words are runs of letters and digits in lower case; a text of fewer words than a shingle is one shingle. Defined
results: a null or wordless text has fingerprint zero; two such texts are alike (1), such a text and another are not
(0); equal texts have equal fingerprints. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchledger.llm.common import Words, cut, map_arrow, mix, shingle_hashes, slices

BINS, BITS, SHINGLE = 256, 4, 5
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketch(texts: list[str], bins: int = BINS, bits: int = BITS, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """((texts, bins) of uint8: the low bits of each bin; whether a text has words)"""
    h, first = shingle_hashes(Words(texts), k)
    width = np.uint64(64 - (bins.bit_length() - 1))
    least = np.full(len(texts) * bins, _EMPTY)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    np.minimum.at(least, doc * bins + (h >> width).astype(np.int64), h & ((np.uint64(1) << width) - np.uint64(1)))
    least = least.reshape(-1, bins)
    full = least != _EMPTY
    row, col = np.nonzero(~full & full.any(axis=1, keepdims=True))
    attempt = 0
    while len(row):
        attempt += 1
        at = (mix(np.arange(bins, dtype=np.uint64) + np.uint64(attempt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(bins)).astype(np.int64)[col]
        hit = full[row, at]
        least[row[hit], col[hit]] = least[row[hit], at[hit]]
        row, col = row[~hit], col[~hit]
    return np.where(full.any(axis=1, keepdims=True), (mix(least) & np.uint64((1 << bits) - 1)).astype(np.uint8), np.uint8(0)), full.any(axis=1)


def pack(low: np.ndarray, bits: int = BITS) -> list[str]:
    """Each row's bins, `bits` bits each, as hex."""
    spread = ((low[:, :, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint8)) & 1).reshape(len(low), -1)
    return [x.tobytes().hex() for x in np.packbits(spread, axis=1)]


def likeness(a: np.ndarray, b: np.ndarray, has_a: np.ndarray, has_b: np.ndarray, bits: int = BITS) -> np.ndarray:
    chance = 2.0**-bits
    share = (a == b).mean(axis=1) if a.shape[1] else np.zeros(len(a))
    return np.where(has_a & has_b, np.clip((share - chance) / (1 - chance), 0, 1), (has_a == has_b).astype(float))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id_col, fingerprint (hex)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        prints = [p for i, j in slices(texts) for p in pack(sketch(texts[i:j])[0])]
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints, pa.string())], ["id", "fingerprint"])

    return map_arrow(rows, run, f"id {dict(rows.dtypes)['id']}, fingerprint string").withColumnRenamed("id", id_col)


_DIGEST = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(texts: list[str], following: list[str]) -> dict[str, list]:
    """What with_next() returns for these texts, each with the text after it."""
    quarter = [len(t) // 4 for t in texts]
    edited = [t[: len(t) - q] + f[:q] for t, f, q in zip(texts, following, quarter, strict=True)]
    (a, has_a), (e, has_e), (n, has_n) = sketch(texts), sketch(edited), sketch(following)
    return {
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
        "fingerprint": pack(a),
        "edited_fingerprint": pack(e),
        "near_edited": likeness(a, e, has_a, has_e),
        "near_next": likeness(a, n, has_a, has_n),
    }


def with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document against its edited text (the last quarter replaced by the beginning of the document with the next id; after the last comes the first) and against that next document.

    Rows are range-partitioned by id and sorted (null ids first; equal ids by a hash of the text). A task knows the
    next row of all its rows but the last, so it hands out its first and last row's texts with its number. A window over
    these numbers (no texts) tells which partition comes next, and a join on it brings each last text the first text
    of that partition."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["id"]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "id").sortWithinPartitions("id", F.xxhash64("text")).withColumn("part", F.spark_partition_id())

    def batch_of(ids: list, id_type: pa.DataType, got: dict, part: int, head: list, tail: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        cols = [pa.array(v, t) for v, t in zip(got.values(), kinds, strict=True)]
        ends = [pa.array([part] * len(ids), pa.int32()), pa.array(head, pa.string()), pa.array(tail, pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *cols, *ends], ["id", *got, "part", "head", "tail"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, begun, id_type, part = [], [], False, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            ids, texts, id_type, part = ids + b.column("id").to_pylist(), texts + b.column("text").to_pylist(), b.column("id").type, b.column("part")[0].as_py()
            for i, j in slices(texts[:-1]):
                yield batch_of(ids[i:j], id_type, _compared(texts[i:j], texts[i + 1 : j + 1]), part, [texts[0] if not (begun or i or k) else None for k in range(j - i)], [None] * (j - i))
            begun = begun or len(texts) > 1
            ids, texts = ids[-1:], texts[-1:]
        if ids:
            yield batch_of(ids, id_type, dict.fromkeys((x.split()[0] for x in _DIGEST.split(", ")), [None]), part, [None if begun else texts[0]], texts)

    done = cut(ordered.mapInArrow(run, f"id {kind}, {_DIGEST}, part int, head string, tail string"), "compared")
    heads = done.where("head is not null").select(F.col("part").alias("next"), F.col("head").alias("following"))  # one row for each partition
    order = Window.orderBy("part")
    ends = done.where("tail is not null")
    parts = ends.select("part").withColumn("next", F.coalesce(F.lead("part").over(order), F.first("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    edge = ends.select("id", "part", "tail").join(parts, "part").join(heads, "next").select("id", "tail", "following")

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = _compared(batch.column("tail").to_pylist(), batch.column("following").to_pylist())
        one = batch_of(batch.column("id").to_pylist(), batch.column("id").type, got, 0, [None] * batch.num_rows, [None] * batch.num_rows)
        return one.select(["id", *got])

    return done.where("tail is null").drop("part", "head", "tail").union(map_arrow(edge, finish, f"id {kind}, {_DIGEST}")).withColumnRenamed("id", id_col)
