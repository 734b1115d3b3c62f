"""SimHash near-duplicates with pivot distance tables.

Every text gets a 64-bit fingerprint: bit i is 1 if over half of the XXH64 values of its word shingles have it. Each
distinct fingerprint gets a pivot table row: its Hamming distances to 16 fixed reference fingerprints. Two
fingerprints at distance d differ by at most d in every coordinate, so a pair whose largest coordinate difference is
over the limit is discarded, and the survivors are verified bit by bit.

Pivot coordinates of random fingerprints all lie near 32, so they cannot deal out the pairs by themselves. For that
the 64 bits are cut into blocks: of r blocks, a pair that differs in at most `most` bits agrees in r - most of them
(pigeonhole), so only pairs that agree in such a choice of blocks meet; r grows with the number of fingerprints. A
bucket of more than `bucket_rows` distinct fingerprints (thousands of near copies) is split by a hash into parts, and
each two parts meet as a bucket of their own. Links are kept as a spanning forest of each bucket: no link between two
components is lost, and no group is expanded into all its pairs.

keep_one(), the near-duplicate stage of five words and a similarity of 0.8, is in near_sets.

Defined results: equal fingerprints are linked, and a text without words (or null) has fingerprint zero, linked like
any other; an empty table gives an empty result; rows with equal or null ids are fingerprinted each by itself, and a
component id is the smallest id that is not null. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchledger.llm.common import cut, map_arrow, mix, slices
from matchledger.llm.components import components

SEED = 42


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: 16 reference fingerprints.
PIVOTS = [signed(int(x)) for x in mix(np.arange(1, 17, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))]


def shingles(text: str, k: int) -> list[int]:
    """XXH64 of each run of k words, repeats included; of all words where there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z only, and ASCII white space
    if not words:
        return []
    if len(words) <= k:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    starts = [0, *(e + 1 for e in ends[: len(words) - k])]
    return [h(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1 :], strict=True)]


def fingerprint(texts: list[str], k: int) -> np.ndarray:
    """uint64 of each text."""
    lists = [shingles(t, k) for t in texts]
    n = np.array([len(x) for x in lists], np.int64)
    first = np.concatenate(([0], np.cumsum(n)))
    h = np.fromiter((v for x in lists for v in x), np.uint64, int(first[-1]))
    bits = np.zeros((len(texts), 64), bool)
    full = np.flatnonzero(n)
    if len(full):
        every = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits[full] = 2 * np.add.reduceat(every, first[full], axis=0, dtype=np.int32) > n[full][:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 4) -> DataFrame:
    """(id, fp bigint)"""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        fp = np.zeros(len(texts), np.uint64)
        for i, j in slices(texts, 1 << 20):
            fp[i:j] = fingerprint(texts[i:j], k)
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fp.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    return map_arrow(rows, run, f"id {dict(rows.dtypes)['id']}, fp long")


def masks(n: int, most: int, bucket: int = 16) -> list[int]:
    """Bit masks of the block choices; enough blocks that a bucket of n random fingerprints holds about `bucket` at most. Two fingerprints that differ in at most `most` bits agree under one of them."""
    r = most + 2
    while n / 2 ** (64 * (r - most) / r) > bucket and r < 2 * most + 8:
        r += 1
    edge = [64 * i // r for i in range(r + 1)]
    block = [((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in range(r)]
    return [signed(sum(block[i] for i in c)) for c in combinations(range(r), r - most)]


#: What tells buckets apart: the choice of blocks, their bits, and two parts of a bucket that is split.
BUCKET = ["band", "key", "i", "j"]


def pivot_table(prints: DataFrame, *also: str) -> DataFrame:
    """(also, fp, p0, p1): each long packs eight distances of a byte each."""
    packed = [sum((F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("long"), 8 * i) for i, p in enumerate(PIVOTS[k : k + 8])), F.lit(0).cast("long")) for k in (0, 8)]
    return prints.select(*also, "fp", packed[0].alias("p0"), packed[1].alias("p1"))


def bucket_links(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows (band, key, i, j, fp, p0, p1), those of a bucket and its parts i and j together -> a spanning forest of the links of each."""
    held: dict[str, np.ndarray] | None = None
    for b in chain(batches, [None]):
        if b is not None:
            if not b.num_rows:
                continue
            new = {c: b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names}
            held = {c: np.concatenate((held[c], new[c])) for c in new} if held else new
        if not held:
            continue
        n = len(held["fp"])
        change = np.flatnonzero(np.any([held[c][1:] != held[c][:-1] for c in BUCKET], axis=0)) + 1
        done = n if b is None else int(change[-1]) if len(change) else 0
        rows, held = {c: v[:done] for c, v in held.items()}, {c: v[done:] for c, v in held.items()}
        if done:
            yield _links(rows, change[change < done], most)


def _links(rows: dict[str, np.ndarray], change: np.ndarray, most: int) -> pa.RecordBatch:
    n = len(rows["fp"])
    pivots = np.ascontiguousarray(np.array([rows["p0"], rows["p1"]], np.int64).T).view(np.uint8).astype(np.int16)  # (n, 16)
    child, root = forest(rows["fp"].view(np.uint64)[:, None], pivots, change, n, most)
    return pa.RecordBatch.from_arrays([pa.array(rows["fp"][child]), pa.array(rows["fp"][root])], ["a", "b"])


def forest(fp: np.ndarray, pivots: np.ndarray, change: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """fp: (n, words of 64 bits); change: where a new bucket begins -> (row, root) of a spanning forest of each bucket's links. Pairs are taken by their distance in the list, all buckets side by side; a pair is dropped by its largest pivot coordinate difference before its bits are counted."""
    end = np.repeat(np.concatenate((change, [n])), np.diff(np.concatenate(([0], change, [n]))))  # of each row's bucket
    root, i, step, found, waiting = np.arange(n), np.arange(n), 1, [], 0
    while len(i := i[i + step < end[i]]):
        near = i[root[i] != root[i + step]]  # pairs that are not in one tree already
        near = near[np.abs(pivots[near] - pivots[near + step]).max(axis=1) <= most]
        near = near[np.bitwise_count(fp[near] ^ fp[near + step]).sum(axis=1, dtype=np.int16) <= most]
        found.append(np.array([near, near + step]))
        step, waiting = step + 1, waiting + len(near)
        if waiting >= 2048:
            root, found, waiting = merged(root, np.concatenate(found, axis=1)), [], 0
    root = merged(root, np.concatenate([*found, np.zeros((2, 0), np.int64)], axis=1))
    child = np.flatnonzero(root != np.arange(n))
    return child, root[child]


def merged(root: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """root: the smallest row of each row's tree -> the same after joining the trees of each pair."""
    root = root.copy()
    while True:
        x, y = root[pairs[0]], root[pairs[1]]
        if (x == y).all():
            return root
        least = np.minimum(x, y)
        np.minimum.at(root, x, least)
        np.minimum.at(root, y, least)
        while not ((up := root[root]) == root).all():
            root = up


def links(prints: DataFrame, most: int = 4, bucket_rows: int = 4096) -> DataFrame:
    """prints: distinct fp, as a table that is cheap to read. (a, b): edges between fingerprints that differ in at most `most` bits, enough of them that their components are those of all such pairs."""
    at = masks(prints.count(), most)
    keys = prints.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in at))).alias("band", "key"))
    sizes = keys.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = cut(sizes.select("band", "key", F.when(F.col("n") > bucket_rows, F.ceil(2 * F.col("n") / bucket_rows)).otherwise(1).cast("int").alias("parts")), "buckets")
    dealt = keys.join(parts, ["band", "key"]).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("parts = 1 or part <> other")
    met = met.select("band", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "fp").repartition(*BUCKET)
    return pivot_table(met, *BUCKET).sortWithinPartitions(*BUCKET).mapInArrow(lambda batches: bucket_links(batches, most), "a long, b long")


def cluster(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 4, most: int = 4, bucket_rows: int = 4096) -> DataFrame:
    """id_col, fp bigint, component_id: one row for each row of docs."""
    prints = cut(fingerprints(docs, id_col, text, k), "fingerprints")
    unique = cut(prints.groupBy("fp").agg(F.min("id").alias("rep")), "unique")
    roots = components(links(unique.select("fp"), most, bucket_rows))
    rooted = unique.join(roots, unique["fp"] == roots["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")
