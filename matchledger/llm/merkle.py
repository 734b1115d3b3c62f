"""A Merkle manifest of a dataset: a tree of digests for each group of rows, and a tree over the groups' roots.

A leaf is the digest of a row's fields. Within a group (a language), leaves stand in the order of their ids; every ARITY
consecutive nodes of a level have one parent, the digest of theirs as hex text, until one node is left: the group's
root. The groups' roots, in the order of the groups (null first), are the leaves of the tree above.

Up: events meet in partial parents, as in combineByKey. A partial parent holds the digests of the children seen so far
by their places. How many it waits for follows from the size of its group alone; the last child completes it, and its
digest is the next event, for its own parent. Each task completes what it can of the rows it has, which stand in order,
and hands out the rest: the frontier, a few partial parents for each level and task. It is shuffled by blocks of
consecutive leaves, blocks of the next round being ARITY**ROUND_LEVELS times as wide, until nothing is unresolved.

Down: a complete node lists its children, so its proof (the siblings on the way to the root) reaches each of them by a
join of one level with the next. A proof is bytes: for each level the place among the siblings, how many nodes the
run has, and the digests of the others. fold() recomputes a root from a leaf and its proof.

Rows are read once; only ids and digests are shuffled. Tables: leaves, nodes of each round, places.

Defined results: null fields count as `-`; rows without an id stand before all others and are leaves like any; rows that
share an id stand in the order of their digests, so rows that are alike throughout are leaves of their own; a group of
one row has its leaf as its root; one group alone has its root as the root of all; an empty table gives an empty one.
Texts of any length are digested in the JVM, row by row. A row's further columns are not part of its leaf unless named.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchledger.llm.common import cut, map_arrow
from matchledger.operators.ordering import positions

ARITY, BITS = 8, 3
#: Levels that a round of the frontier completes at least.
ROUND_LEVELS = 6
#: Nodes from this level on are few, and are read apart when proofs go down.
UPPER = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PARENTS = "grp string, n long, level int, idx long, mask int, parts binary, digest binary, top boolean"


@dataclass(frozen=True)
class Manifest:
    """leaves (grp, n, pos, digest and what was carried), nodes (grp, n, level, idx, parts, digest, top), roots (grp, level, digest)."""

    leaves: DataFrame
    nodes: DataFrame
    roots: DataFrame


def encoded(value: Column) -> Column:
    """A field as it is digested: `-` for null, else its length in bytes and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*(encoded(f) for f in fields)), 256))


def parent(parts: bytes) -> bytes:
    """The digest of a node whose children's digests are given one after the other."""
    return hashlib.sha256(parts.hex().encode()).digest()


def width(n: int, level: int) -> int:
    """Nodes of a level over n leaves."""
    return -(-n >> BITS * level) if level else n


class _Combiner:
    """Partial parents of one task, and the nodes that are complete."""

    def __init__(self) -> None:
        self.open: dict[tuple, list] = {}
        self.done: list[tuple] = []

    def merge(self, grp: str, n: int, level: int, idx: int, mask: int, parts: bytes) -> None:
        """Children (mask: their places) of the parent idx at a level, and the ancestors that they complete."""
        while True:
            key = (grp, level, idx)
            held = self.open.get(key)
            if held is None:
                held = self.open[key] = [n, 0, [b""] * ARITY]
            at = 0
            for slot in range(ARITY):
                if mask >> slot & 1:
                    held[2][slot] = parts[at : at + 32]
                    at += 32
            held[1] |= mask
            arity = min(ARITY, width(n, level - 1) - idx * ARITY)
            if held[1].bit_count() < arity:
                return
            del self.open[key]
            children = b"".join(held[2])
            digest = parent(children)
            top = width(n, level) == 1
            self.done.append((grp, n, level, idx, held[1], children, digest, top))
            if top:
                return
            level, idx, mask, parts = level + 1, idx >> BITS, 1 << (idx & ARITY - 1), digest

    def take(self) -> pa.RecordBatch:
        rows, self.done = self.done, []
        return _batch(rows)

    def rest(self) -> pa.RecordBatch:
        return _batch([(g, n, level, idx, mask, b"".join(slots), None, False) for (g, level, idx), (n, mask, slots) in self.open.items()])


_ARROW = pa.schema([("grp", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("mask", pa.int32()), ("parts", pa.binary()), ("digest", pa.binary()), ("top", pa.bool_())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def combine(events: DataFrame) -> DataFrame:
    """Partial parents (grp, n, level, idx, mask, parts) -> complete nodes, and with a null digest what is unresolved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combiner = _Combiner()
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("grp", "n", "level", "idx", "mask", "parts")), strict=True):
                combiner.merge(*row)
            yield combiner.take()
        yield combiner.rest()

    return events.select("grp", "n", "level", "idx", "mask", "parts").mapInArrow(run, PARENTS)


def tree(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, roots) of leaves (grp, n: leaves of the group, pos, digest)."""
    mask = F.expr(f"shiftleft(1, CAST(pmod(pos, {ARITY}) AS INT))")
    events = leaves.where("n > 1").select("grp", "n", F.lit(1).alias("level"), F.shiftright("pos", BITS).alias("idx"), mask.alias("mask"), F.col("digest").alias("parts"))
    rounds, reach = [cut(combine(events), "nodes")], 0
    while not (frontier := rounds[-1].where("digest is null")).isEmpty():
        reach += ROUND_LEVELS
        block = F.expr(f"shiftright(shiftleft(idx, {BITS} * level), {BITS * reach})").alias("block")
        rounds.append(cut(combine(frontier.repartition("grp", block)), "nodes"))
    nodes = reduce(DataFrame.union, (r.where("digest is not null") for r in rounds)).select("grp", "n", "level", "idx", "parts", "digest", "top")
    lone = leaves.where("n = 1").select("grp", F.lit(0).alias("level"), "digest")
    return nodes, nodes.where("top").select("grp", "level", "digest").union(lone)


def _step(parts: Column, slot: Column) -> Column:
    """A level of a proof: place, size of the run, the others' digests."""
    count = (F.octet_length(parts) / 32).cast("int")
    others = F.concat(F.substring(parts, F.lit(1), slot * 32), F.substring(parts, slot * 32 + 33, F.lit(32 * ARITY)))
    return F.concat(F.unhex(F.format_string("%02X%02X", slot.cast("int"), count)), others)


def proven(leaves: DataFrame, nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """leaves with proof and the columns of tops (grp, level of its root, up: proof of the root itself, and more)."""
    more = [c for c in tops.columns if c not in ("grp", "level", "up")]
    upper = cut(nodes.where(F.col("level") >= UPPER), "upper")
    down = None
    for level in range((tops.agg(F.max("level")).first()[0] or 0), 0, -1):
        here = tops.where(F.col("level") == level).select("grp", F.lit(0).cast("long").alias("idx"), "up", *more)
        here = here if down is None else down.unionByName(here)
        own = (upper if level >= UPPER else nodes).where(F.col("level") == level).select("grp", "idx", "parts").join(here, ["grp", "idx"])
        if level == 1:
            down = own
        else:
            slots = F.explode(F.sequence(F.lit(0), (F.octet_length("parts") / 32).cast("int") - 1)).alias("slot")
            each = own.select("*", slots)
            down = each.select("grp", (F.col("idx") * ARITY + F.col("slot")).alias("idx"), F.concat(_step(F.col("parts"), F.col("slot")), "up").alias("up"), *more)
    lone = tops.where("level = 0").select("grp", F.lit(0).cast("long").alias("idx"), F.lit(None).cast("binary").alias("parts"), "up", *more)
    over = lone if down is None else down.unionByName(lone)
    own = over.select("grp", F.col("idx").alias("__idx"), "parts", "up", *more)
    met = leaves.withColumn("__idx", F.shiftright("pos", BITS)).join(own, ["grp", "__idx"])
    proof = F.when(F.col("parts").isNull(), F.col("up")).otherwise(F.concat(_step(F.col("parts"), F.pmod("pos", F.lit(ARITY)).cast("int")), "up"))
    return met.select(*leaves.columns, proof.alias("proof"), *more)


def _read(proof: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at < len(proof):
        slot, count = proof[at], proof[at + 1]
        yield slot, proof[at + 2 : at + 2 + 32 * (count - 1)]
        at += 2 + 32 * (count - 1)


def fold(start: bytes, proof: bytes) -> bytes:
    """The root that a leaf and a proof lead to."""
    for slot, others in _read(proof):
        start = parent(others[: 32 * slot] + start + others[32 * slot :])
    return start


def siblings(proof: bytes) -> str:
    """The siblings' digests as hex text, level by level."""
    return "".join(others.hex() for _, others in _read(proof))


def build(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS, carried: dict[str, Column] | None = None) -> Manifest:
    """The trees of all groups. leaves also has the key, the group's value and the columns `carried`."""
    rows = docs.select(encoded(F.col(group)).alias("grp"), F.col(group).alias("group_value"), F.col(key).alias("key"), leaf(*(F.col(f) for f in fields)).alias("digest"), *(v.alias(c) for c, v in (carried or {}).items()))
    rows = cut(rows, "rows")  # ranges are sampled first, which would digest all texts twice
    placed = cut(positions(rows, ["grp"], ["key", "digest"], cut, "pos"), "places")
    sizes = cut(placed.groupBy("grp").agg(F.count("*").alias("n")), "sizes")
    leaves = placed.join(sizes, "grp")
    return Manifest(leaves, *tree(leaves))


def proofs(m: Manifest) -> DataFrame:
    """(grp, pos, key, digest, carried columns, subroot, root, proof: to the root of all) of every leaf."""
    values = m.leaves.where("pos = 0").select("grp", "group_value")
    subroots = m.roots.join(values, "grp").select(F.lit("").alias("all"), "group_value", F.col("grp").alias("own"), "level", "digest")
    placed = cut(positions(subroots, ["all"], ["group_value"], cut, "pos"), "subroots")
    sized = placed.join(placed.groupBy("all").agg(F.count("*").alias("n")), "all").withColumnRenamed("all", "grp")
    nodes, root = tree(sized)
    none = F.lit(b"")
    tops = proven(sized, nodes, root.select("grp", "level", none.alias("up"), F.col("digest").alias("root")))
    tops = cut(tops.select(F.col("own").alias("grp"), "level", F.col("proof").alias("up"), F.col("digest").alias("subroot"), "root"), "tops")
    return proven(m.leaves, m.nodes, tops)


def audit(docs: DataFrame, changed: Callable[[str], Column], tampered: Column, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Every row's leaf, subroot, root and proof, and the root that its proof gives after tampering: where `tampered`
    holds, each field f is changed(f). (key, leaf, subroot, root, proof_sha256, folded_root, verified), digests as hex text."""
    other = F.when(tampered, leaf(*(changed(f) for f in fields)))
    told = proofs(build(docs, key, group, fields, {"other": other}))

    def check(b: pa.RecordBatch) -> pa.RecordBatch:
        leaf_, other_, proof, subroot, root = (b.column(c).to_pylist() for c in ("digest", "other", "proof", "subroot", "root"))
        folded = [fold(o or d, p) for d, o, p in zip(leaf_, other_, proof, strict=True)]
        hexed = lambda xs: [x.hex() for x in xs]
        out = {
            "leaf": hexed(leaf_), "subroot": hexed(subroot), "root": hexed(root), "proof_sha256": [hashlib.sha256(siblings(p).encode()).hexdigest() for p in proof],
            "folded_root": hexed(folded), "verified": [f == r for f, r in zip(folded, root, strict=True)],
        }
        return pa.RecordBatch.from_arrays([b.column("key"), *(pa.array(v, pa.bool_() if k == "verified" else pa.string()) for k, v in out.items())], [key, *out])

    kind = docs.schema[key].dataType.simpleString()
    asked = told.select("key", "digest", "other", "proof", "subroot", "root")
    return map_arrow(asked, check, f"`{key}` {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
