"""Helpers shared by the text operators: shared storage, Arrow mapping, vectorised word hashing."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Characters that numpy handles at a time; a longer text makes a slice of its own.
SLICE_CHARS = 1 << 21
#: Bytes of a batch that the stages of a pipeline handle at a time.
PIECE = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, which must be set."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
    return f"{at.rstrip('/')}/matchledger-{spark.sparkContext.applicationId}"


def _write(df: DataFrame, name: str) -> str:
    at = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(at)
    return at


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: the lineage ends there, nothing runs twice, and Spark knows its size when it chooses a join."""
    return df.sparkSession.read.schema(df.schema).parquet(_write(df, name))


class Scratch:
    """cut() for tables that only the steps within a `with` block read: they are deleted at its end, so what leaves the block must be a table of its own."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(_write(df, name))
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def __exit__(self, *_) -> None:
        context = self.spark.sparkContext
        for at in self.paths:
            path = context._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def crc_mod(id_col: str, n: int, equals: int) -> Column:
    """crc32 of the id as text, mod n, equals the given value; false where the id is null."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n)) == equals, F.lit(False))


def map_arrow(df: DataFrame, of_batch: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, most: int = 0) -> DataFrame:
    """mapInArrow for a function of one batch; empty batches are skipped. most: bytes that the function is given at a
    time (a larger row comes by itself), after which each task gives its memory back; 0 for whole batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in pieces(b, most) if most else (b,):
                if part.num_rows:
                    yield of_batch(part)
        if most:
            release()

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in halves of halves, until each has at most so many bytes or one row. Nothing is copied."""
    if batch.num_rows < 2 or batch.nbytes <= most:
        yield batch
        return
    half = batch.num_rows // 2
    yield from pieces(batch.slice(0, half), most)
    yield from pieces(batch.slice(half), most)


def release() -> None:
    """Give back what a task has freed. Python workers outlive their tasks, and other stages run beside them."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):  # GNU only
        libc.malloc_trim(0)


def slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most so many characters, at least one text each."""
    i, n = 0, 0
    for j, t in enumerate(texts):
        if j > i and n + len(t) > most:
            yield i, j
            i, n = j, 0
        n += len(t)
    if i < len(texts):
        yield i, len(texts)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^n modulo 2^64; kept for the next slice."""
    if len(_powers.get(base, ())) <= n:
        p = np.full(1 << n.bit_length(), base, np.uint64)  # over n, and at most twice of it
        p[0] = 1
        _powers[base] = np.multiply.accumulate(p)
    return _powers[base][: n + 1]


#: True for bytes of words: ASCII letters and digits, and all of every character beyond ASCII.
WORD_BYTE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


class Words:
    """The words of some texts as flat arrays: doc (which text), hash (64 bits), and byte offsets in one buffer."""

    def __init__(self, texts: list[str], lower: bool = True):
        parts = [(t.lower() if lower else t).encode("utf-8", "surrogatepass") for t in texts]
        self.buf = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        self.at = np.cumsum([0] + [len(p) + 1 for p in parts])  # where each text starts
        inside = WORD_BYTE[self.buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside)).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]  # the buffer ends with a newline, so edges pair up
        n = len(self.buf)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n)[:n], out=self._sums[1:])
        self.hash = self._between(self.end)
        self.first = np.searchsorted(self.start, self.at)  # the first word of each text; one more at the end
        self.count = np.diff(self.first)

    def _between(self, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[self.start]) * _power(_INVERSE, len(self.buf))[self.start] + (end - self.start).astype(np.uint64))

    def prefix_hash(self, n: int) -> np.ndarray:
        """Of each word's first n bytes; differs from the hash of a word of these bytes."""
        return ~self._between(np.minimum(self.start + n, self.end))

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each k-word shingle, first shingle of each text and one more). A shorter text has one, of all its words; one without words has none."""
    n = np.maximum(words.count - k + 1, np.minimum(words.count, 1))
    first = np.concatenate(([0], np.cumsum(n)))
    at = np.repeat(words.first[:-1] - first[:-1], n) + np.arange(first[-1])
    left = np.repeat(words.first[1:], n) - at  # words from here to the end of the text
    h = np.zeros(len(at), np.uint64)
    for i in range(k):
        has = left > i
        h = np.where(has, mix(h * np.uint64(_BASE) + words.hash[np.minimum(at + i, max(len(words.hash) - 1, 0))]) if len(words.hash) else h, h)
    return h, first
