"""Near-duplicates by sets of word shingles: the SimHash operator for similarities at which 64 bits tell too little.

Texts whose sets of k-word shingles have a Jaccard similarity of 0.8 or more are linked, transitively. Such texts differ
in every seventh bit of a SimHash, so neither 4 of 64 bits nor choices of bits (their number would grow with the corpus)
find them. Pairs are found, discarded and verified in three steps:

1. Buckets. Each set has 18 keys of 5 minima each (a shingle is hashed once into one of 90 bins; empty bins copy full
   ones). Two sets alike by 0.8 share no key with a probability of (1 - 0.8^5)^18 = 0.0008, whatever the size of the
   corpus, and sets with little in common share none.
2. Discarding. Each set has a SimHash of 256 bits, in which sets alike by 0.8 differ in 39 bits on average (a standard
   deviation of 6). Pairs that differ in more than 60 bits are discarded; within a bucket first by the differences of their
   distances to reference fingerprints (pivots), which are taken from the bucket itself, as all distances to random
   fingerprints are about 128.
3. Verifying. The sets of the survivors are compared. No pair under 0.8 is linked.

First each member of a bucket is compared with one member, its lead: as many pairs as rows, which links most of a large
group of near copies. Buckets that still hold several components get further leads, from what no lead has met. Only what
is apart after that is compared whole, in blocks of two parts of bounded size; parts of the bucket's largest component do
not meet each other. Blocks carry fingerprints and keys, and tell which of their rows have a near one at all; only these
rows' sets are fetched then, for the blocks that they have it in. Links are told as a spanning forest.

Defined results: texts of one set are one node, also texts without words and nulls; a text of fewer than k words has one
shingle, all its words; rows without an id are left out of groups and stay; an empty table gives an empty result. Sets
are told apart by 64 bits, and compared by the low 32 bits of their shingles' hashes: of two sets of 20,000, 0.1 shingles
are taken for equal that are not. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchledger.llm.common import PIECE, Scratch, Words, cut, map_arrow, mix, pieces, release, shingle_hashes, slices
from matchledger.llm.components import components

#: Words of 64 bits of a SimHash, and the bits in which two texts may differ there to be compared by their sets.
WORDS, MOST = 4, 60
#: Keys of a set, and the minima in each.
BANDS, ROWS = 18, 5
FP, KEYS = [f"f{i}" for i in range(WORDS)], [f"k{i}" for i in range(BANDS)]
#: A part of a bucket holds about so many rows, and shingles, at most.
PART_ROWS, PART_SHINGLES = 8192, 4_000_000
#: Leads that a bucket's members are compared with before any block.
LEADS = 3
PIVOTS = 8

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_GOLD = 0x9E3779B97F4A7C15


def _salt(n: int) -> np.uint64:
    return np.uint64(n * _GOLD & 0xFFFFFFFFFFFFFFFF)


#: Of each bin the order in which it asks the others for a minimum, itself first.
_ORDER = np.array([np.argsort(np.argsort(np.where(np.arange(BANDS * ROWS) == j, 0, mix(np.arange(BANDS * ROWS, dtype=np.uint64) + _salt(j + 1)) >> np.uint64(1)))) for j in range(BANDS * ROWS)]).astype(np.uint8)


def shingle_sets(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each distinct k-word shingle, in order within a text; where each text starts and one more)"""
    h, first = shingle_hashes(Words(texts), k)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        h[i:j].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.concatenate(([0], np.cumsum(np.bincount(doc[new], minlength=len(texts)))))


def node_of(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64 bits that stand for each set; 0 for an empty one."""
    full = np.flatnonzero(np.diff(first))
    out = np.zeros(len(first) - 1, np.uint64)
    if len(full):
        out[full] = mix(np.add.reduceat(mix(h ^ _salt(5)), first[full]))
    return out


def simhash(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, WORDS): the SimHash of each set; 0 for an empty one."""
    n = np.diff(first)
    full = np.flatnonzero(n)
    out = np.zeros((len(n), WORDS), np.uint64)
    for w in range(WORDS if len(full) else 0):
        bits = np.unpackbits(mix(h + _salt(w)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        over = 2 * np.add.reduceat(bits, first[full], axis=0, dtype=np.int32) > n[full][:, None]
        out[full, w] = np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out


def band_keys(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, BANDS): the keys of each set; those of an empty one mean nothing."""
    bins, docs = BANDS * ROWS, len(first) - 1
    v = mix(h + _salt(77))
    doc = np.repeat(np.arange(docs), np.diff(first))
    least = np.full(docs * bins, _EMPTY)
    np.minimum.at(least, doc * bins + ((v >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64), v)
    least = least.reshape(docs, bins)
    full = least != _EMPTY
    lacking = np.flatnonzero(~full.all(axis=1))
    for s in range(0, len(lacking), 512):
        part = lacking[s : s + 512]
        at = np.where(full[part][:, None, :], _ORDER[None], np.uint8(255)).argmin(axis=2)
        least[part] = np.take_along_axis(least[part], at, axis=1)
    out = np.empty((docs, BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(docs, b, np.uint64)
        for i in range(ROWS):
            key = mix(key * np.uint64(_GOLD) + least[:, b * ROWS + i])
        out[:, b] = key
    return out


def prints_of(docs: DataFrame, id_col: str, text: str, k: int) -> DataFrame:
    """(id, h: hash of the text, node, n, f0 .., k0 ..): n is the size of the set that node stands for."""
    cols = ["node", "n", *FP, *KEYS]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        out = np.zeros((len(texts), len(cols)), np.uint64)
        for i, j in slices(texts, 1 << 19):
            h, first = shingle_sets(texts[i:j], k)
            out[i:j, 0], out[i:j, 1] = node_of(h, first), np.diff(first)
            out[i:j, 2 : 2 + WORDS], out[i:j, 2 + WORDS :] = simhash(h, first), band_keys(h, first)
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h"), *(pa.array(c.view(np.int64)) for c in np.ascontiguousarray(out.T))], ["id", "h", *cols])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    return map_arrow(rows, run, f"id {dict(rows.dtypes)['id']}, h long, " + ", ".join(f"{c} long" for c in cols), PIECE)


def set_table(docs: DataFrame, text: str, k: int) -> DataFrame:
    """(node, shingles array<int>): the low 32 bits of the distinct shingles of each text, in order."""

    def of_piece(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [t or "" for t in piece.column("text").to_pylist()]
        for i, j in slices(texts, 1 << 19):
            h, first = shingle_sets(texts[i:j], k)
            doc = np.repeat(np.arange(j - i, dtype=np.uint64), np.diff(first))
            low = np.unique((doc << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF)))  # in order of text and value
            ends = np.searchsorted(low >> np.uint64(32), np.arange(j - i + 1, dtype=np.uint64)).astype(np.int32)
            values = (low & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(node_of(h, first).view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["node", "shingles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for piece in pieces(b, PIECE):
                yield from of_piece(piece)
        release()

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "node long, shingles array<int>")


def alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) of nodes -> those whose sets have a Jaccard similarity of 0.8 or more."""
    left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(s)) for c, s in (("a", "x"), ("b", "y")))
    shared = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").where(5 * shared >= 4 * (F.size("x") + F.size("y") - shared)).select("a", "b")


def survivors(pairs: DataFrame, unique: DataFrame) -> DataFrame:
    """pairs (a, b) of nodes -> those of sizes that allow a similarity of 0.8 whose fingerprints differ in MOST bits at most."""
    left, right = (unique.select(*(F.col(c).alias(f"{s}_{c}") for c in ("node", "n", *FP))) for s in ("a", "b"))
    both = pairs.join(left, F.col("a") == F.col("a_node")).join(right, F.col("b") == F.col("b_node"))
    apart = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in FP), F.lit(0))
    return both.where((5 * F.least("a_n", "b_n") >= 4 * F.greatest("a_n", "b_n")) & (apart <= MOST)).select("a", "b")


class Block:
    """Rows of one bucket, of two of its parts, or of one part alone."""

    def __init__(self, t: pa.Table, i: int, j: int, key: int):
        column = {c: t.column(c).to_numpy() for c in ("node", "comp", "n", "part", *FP, *KEYS)}
        self.node, self.n = column["node"], column["n"]
        self.tree = np.unique(column["comp"], return_inverse=True)[1]
        self.fp = np.array([column[c] for c in FP]).T.copy().view(np.uint64)
        self.keys = np.array([column[c] for c in KEYS]).T.copy()
        self.band = int((self.keys[0] == key).argmax())
        if "shingles" in t.column_names:
            flat = t.column("shingles").combine_chunks()
            self.at, self.flat = flat.offsets.to_numpy(), flat.values.to_numpy().view(np.uint32)  # in their order
        self.left = np.flatnonzero(column["part"] == i)
        self.right = self.left if i == j else np.flatnonzero(column["part"] == j)

    def proposed(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a left and a right row of different trees and sizes that fit, which share no earlier key, near each other by the pivots and then by their bits."""
        at = np.concatenate((self.left, self.right))
        pivots = at[np.linspace(0, len(at) - 1, PIVOTS).astype(np.int64)]
        far = np.bitwise_count(self.fp[:, None] ^ self.fp[pivots][None]).sum(axis=2, dtype=np.int16)  # (rows, PIVOTS)
        right = self.right[np.argsort(far[self.right, 0], kind="stable")]
        first = far[right, 0]
        step = max(1, (1 << 19) // max(1, len(right)))
        left = self.left[np.argsort(far[self.left, 0], kind="stable")]
        for s in range(0, len(left), step):
            x = left[s : s + step]
            y = right[np.searchsorted(first, far[x[0], 0] - MOST) : np.searchsorted(first, far[x[-1], 0] + MOST, side="right")]
            a, b = (self.n[r].astype(np.int64) for r in (x, y))
            hit = (self.tree[x][:, None] != self.tree[y][None]) & (5 * a[:, None] >= 4 * b[None]) & (5 * b[None] >= 4 * a[:, None])
            if self.left is self.right:
                hit &= x[:, None] < y[None]
            i, j = np.nonzero(hit)
            a, b = x[i], y[j]
            keep = np.abs(far[a] - far[b]).max(axis=1, initial=0) <= MOST
            a, b = a[keep], b[keep]
            keep = np.bitwise_count(self.fp[a] ^ self.fp[b]).sum(axis=1, dtype=np.int16) <= MOST
            a, b = a[keep], b[keep]
            keep = ~(self.keys[a, : self.band] == self.keys[b, : self.band]).any(axis=1)
            yield a[keep], b[keep]

    def near(self) -> np.ndarray:
        """True for rows that are in a proposed pair."""
        out = np.zeros(len(self.node), bool)
        for a, b in self.proposed():
            out[a] = out[b] = True
        return out

    def links(self) -> tuple[list[int], list[int]]:
        """Nodes of a spanning forest of the links between the rows' components."""
        found: tuple[list[int], list[int]] = ([], [])
        for a, b in self.proposed():
            for x in np.unique(a).tolist():
                y = b[a == x]
                y = y[self.tree[y] != self.tree[x]]
                own = self.flat[self.at[x] : self.at[x + 1]]
                for s in range(0, len(y), 64):
                    some = y[s : s + 64]
                    some = some[self.tree[some] != self.tree[x]]
                    if not len(some):
                        continue
                    size = self.at[some + 1] - self.at[some]
                    other = np.concatenate([self.flat[self.at[r] : self.at[r + 1]] for r in some.tolist()])
                    where = np.minimum(np.searchsorted(own, other), len(own) - 1)
                    shared = np.add.reduceat((own[where] == other).astype(np.int64), np.concatenate(([0], np.cumsum(size)[:-1])))
                    for r in some[5 * shared >= 4 * (len(own) + size - shared)].tolist():
                        if self.tree[r] != self.tree[x]:
                            found[0].append(int(self.node[x]))
                            found[1].append(int(self.node[r]))
                            self.tree[self.tree == self.tree[r]] = self.tree[x]
        return found


BLOCK = ["key", "i", "j"]


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Block]]:
    """Rows (key, i, j, part, node, comp, n, f0 .., k0 .. and maybe shingles), those of a block together -> each block of two rows or more."""
    held: list[pa.RecordBatch] = []
    for batch in chain(batches, [None]):
        if batch is not None and batch.num_rows:
            held.append(batch)
            if all(held[0].column(c)[0] == batch.column(c)[-1] for c in BLOCK):
                continue  # the block goes on
        if not held or (batch is not None and not batch.num_rows):
            continue
        t = pa.Table.from_batches(held)
        where = np.array([t.column(c).to_numpy() for c in BLOCK])
        edge = [0, *(np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1).tolist(), t.num_rows]
        done = edge[-1] if batch is None else edge[-2]
        for s, e in zip(edge, edge[1:], strict=False):
            if e <= done and e - s > 1:
                rows = t.slice(s, e - s).combine_chunks()
                yield rows, Block(rows, int(where[1, s]), int(where[2, s]), int(where[0, s]))
        held = t.slice(done).to_batches() if done < t.num_rows else []
    release()


def near_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks without shingles -> (key, i, j, part, node, comp) of those that have a near one in their block."""
    for rows, block in whole_blocks(batches):
        yield from rows.select([*BLOCK, "part", "node", "comp"]).filter(pa.array(block.near())).to_batches()


def block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks with shingles -> (a, b)."""
    for _, block in whole_blocks(batches):
        a, b = block.links()
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def placed(dealt: DataFrame, roots: DataFrame) -> DataFrame:
    """dealt (node ..) with comp, the root of the node; roots: (node, root) of what is linked."""
    return dealt.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")


def lead_links(dealt: DataFrame, unique: DataFrame, sets: DataFrame, at: Scratch, leads: int = LEADS) -> DataFrame:
    """(a, b): links of a bucket's members with its leads. dealt: (key, node, lead, n). Rounds end early where one finds nothing."""
    pairs = at.cut(dealt.where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct(), "pairs")
    found = at.cut(alike(survivors(pairs, unique), sets), "led")
    rows = dealt.select("key", "node", "lead", F.lit(False).alias("met"))
    for _ in range(leads - 1):
        rows = at.cut(placed(rows, components(found)), "placed")
        mixed = rows.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.max(F.when(F.col("node") == F.col("lead"), F.col("comp"))).alias("led")).where("low <> high")
        rows = at.cut(rows.join(mixed, "key").select("key", "node", "comp", (F.col("met") | (F.col("comp") == F.col("led"))).alias("met")), "apart")
        least = rows.where("not met").groupBy("key").agg(F.min(F.struct("node", "comp")).alias("next"))
        rows = at.cut(rows.join(least, "key").select("key", "node", "comp", "met", F.col("next.node").alias("lead"), F.col("next.comp").alias("led")), "again")
        pairs = at.cut(rows.where("comp <> led").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct(), "pairs")
        more = at.cut(alike(survivors(pairs, unique), sets), "led")
        if more.isEmpty():
            break
        found, rows = found.union(more), rows.select("key", "node", "lead", "met")
    return found


def rest_links(dealt: DataFrame, roots: DataFrame, unique: DataFrame, sets: DataFrame, at: Scratch, part_rows: int = PART_ROWS) -> DataFrame:
    """(a, b): links between components in buckets that hold several. dealt: (key, node, lead, n); roots: (node, root) of what is linked already."""
    rows = at.cut(placed(dealt.select("key", "node", "n"), roots), "placed")
    mixed = rows.groupBy("key", "comp").count().groupBy("key").agg(F.count("*").alias("comps"), F.max(F.struct("count", "comp")).alias("most")).where("comps > 1")
    rows = at.cut(rows.join(at.cut(mixed.select("key", F.col("most.comp").alias("main")), "mixed"), "key").select("key", "node", "n", "comp", (F.col("comp") != F.col("main")).alias("other")), "rows")
    parts = lambda of: F.ceil(F.greatest(F.sum(F.when(of, 1)) / part_rows, F.sum(F.when(of, F.col("n"))) / PART_SHINGLES)).cast("int")
    sizes = at.cut(rows.groupBy("key").agg(parts(F.col("other")).alias("others"), parts(~F.col("other")).alias("mains")), "parts")
    h = F.xxhash64("node")
    part = F.when(F.col("other"), F.pmod(h, F.col("others"))).otherwise(F.col("others") + F.pmod(h, F.col("mains"))).cast("int")
    meets = F.sequence(F.lit(0), F.when(F.col("other"), F.col("others") + F.col("mains")).otherwise(F.col("others")) - 1)
    facts = unique.select("node", "n", *FP, *KEYS)
    blocks = rows.drop("n").join(sizes, "key").join(facts, "node").withColumn("part", part).withColumn("with", F.explode(meets))
    blocks = blocks.withColumn("i", F.least("part", "with")).withColumn("j", F.greatest("part", "with")).select(*BLOCK, "part", "node", "comp", "n", *FP, *KEYS)
    together = lambda df, run, schema: df.repartition(*BLOCK).sortWithinPartitions(*BLOCK).mapInArrow(run, schema)
    near = at.cut(together(blocks, near_rows, "key long, i int, j int, part int, node long, comp long"), "near")
    return together(near.join(facts, "node").join(sets, "node").select(*BLOCK, "part", "node", "comp", "n", *FP, *KEYS, "shingles"), block_links, "a long, b long")


def labelled(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5, part_rows: int = PART_ROWS) -> DataFrame:
    """(id, h: hash of the text, first: the smallest (id, h) of the row's group) of each row with an id. Groups are those of near_groups()."""
    with Scratch(docs.sparkSession) as at:
        given = docs.where(F.col(id_col).isNotNull())
        prints = at.cut(prints_of(given, id_col, text, k), "prints")
        unique = at.cut(prints.groupBy("node").agg(F.min(F.struct("id", "h")).alias("rep"), *(F.first(c).alias(c) for c in ("n", *FP, *KEYS))), "unique")
        keys = unique.where("n > 0").select("node", "n", F.explode(F.array(*KEYS)).alias("key"))
        leads = at.cut(keys.groupBy("key").agg(F.count("*").alias("rows"), F.min("node").alias("lead")).where("rows > 1").select("key", "lead"), "leads")
        dealt = at.cut(keys.join(leads, "key"), "dealt")
        ids = at.cut(unique.join(dealt.select("node").distinct(), "node", "left_semi").select(F.col("rep.id").alias(id_col)).distinct(), "ids")
        sets = set_table(given.join(ids, id_col, "left_semi"), text, k)
        if prints.groupBy("id").count().where("count > 1").limit(1).count():  # rows of one id may have one set
            sets = sets.groupBy("node").agg(F.first("shingles").alias("shingles"))
        sets = at.cut(sets, "sets")
        led = lead_links(dealt, unique, sets, at)
        rest = at.cut(rest_links(dealt, components(led), unique, sets, at, part_rows), "rest")
        roots = components(led.union(rest))
        rooted = at.cut(unique.select("node", "rep").join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root")), "rooted")
        named = at.cut(rooted.groupBy("root").agg(F.min("rep").alias("first")), "named")
        named = at.cut(rooted.join(named, "root").select("node", "first"), "components")
        return cut(prints.select("id", "h", "node").join(named, "node").select("id", "h", "first"), "groups")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5, part_rows: int = PART_ROWS) -> DataFrame:
    """(id, component_id): documents whose sets of k-word shingles are alike by 0.8 or more, transitively; component_id is the smallest id. Rows without an id are left out."""
    return labelled(docs, id_col, text, k, part_rows).select("id", F.col("first.id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """One row of docs of each of near_groups(), told by id and text, so that rows of one id with texts of different
    groups all stay: the one with the smallest (id, hash of the text); of rows that are alike in both, the first by a
    hash of all columns. Rows without an id stay."""
    own = labelled(docs, id_col, text, k)
    gone = cut(own.where(F.struct("id", "h") != F.col("first")).select(F.col("id").alias("__id"), F.col("h").alias("__h")).distinct(), "gone")
    rows = docs.withColumn("__hash", F.xxhash64(text))
    kept = rows.join(gone, (F.col(id_col) == F.col("__id")) & (F.col("__hash") == F.col("__h")), "left_anti")
    if not own.where(F.struct("id", "h") == F.col("first")).groupBy("id", "h").count().where("count > 1").limit(1).count():
        return kept.select(*docs.columns)
    nth = F.row_number().over(Window.partitionBy(id_col, "__hash").orderBy(F.xxhash64(*docs.columns)))
    once = kept.where(F.col(id_col).isNotNull()).withColumn("__nth", nth).where("__nth = 1")
    return once.select(*docs.columns).union(kept.where(F.col(id_col).isNull()).select(*docs.columns))
