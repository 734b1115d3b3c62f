"""The prefix trie of conversations: which beginnings they share, and what sharing them saves.

A node is a distinct sequence of first turns (role, text); the root is the empty one. Nothing walks the trie turn by
turn: a node's key is its depth and two sums, over its turns, of 60 bits each of a digest of place, role and text
(120 bits; that two different beginnings of one depth agree has a probability below 1e-20 even for 1e8 nodes), so keys
are running sums, which a conversation of any length gets from ranges of its turns (operators.ordering).

Subtree totals are message passing that peels leaves off. A trie is as deep as its longest conversation, so nodes are
first joined to paths: of the conversations that share a node one is its lead (the longest, of these the one with the
smallest id), and the nodes with one lead are a path from where it parts from a longer one down to its last turn. Each
path ends in one leaf of the trie. Paths hold counters of the paths that hang from them; those without any left are
complete and send their totals (leaves, saved tokens) to the path they hang from, whose counter falls, until only the
root's path finishes. Rounds are as many as longer conversations nest (a single conversation of any length is one),
and the table of pending paths shrinks with each. A node's own totals are then sums from the end of its path up to it.

Texts are read once, for digests and word counts; only those are shuffled. What is joined by a hot beginning has one row
on the other side, so Spark's split of skewed joins holds; counts are combined before they are shuffled. The digest of
the conversations that end in a node is a stream over sorted rows in one task, in constant memory, as SHA-256 asks.

Defined results: null roles and texts are empty; turns stand in the order of turn (null first), equal ones by a digest
of role and text; rows without conv_id belong to no conversation and are left out; a conversation without turns is a
member of the root only; an empty table gives an empty one (there is no root without members).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchledger.llm.common import cut
from matchledger.operators.ordering import positions, running

WORD = r"[^\x20\x09-\x0D]+"
ROOT = "0:0:0"
SUMS = ("s1", "s2")


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos from 1, x: digest of role and text, words) of conversations' turns."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    x = F.sha2(F.concat(F.octet_length(blank(role)).cast("string"), F.lit(":"), blank(role), blank(text)), 256)
    own = rows.where(F.col(conv).isNotNull()).select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), x.alias("x"), F.regexp_count(blank(text), F.lit(WORD)).cast("long").alias("words"))
    own = cut(own, "digests")  # ranges are sampled first, which would digest all texts twice
    return positions(own, ["conv"], ["turn", "x"], cut, "pos").select("conv", (F.col("pos") + 1).alias("pos"), "x", "words")


def rebuilt(own: DataFrame, base: Column, first: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the `first` (at most `most`) turns of conversation `base` and go on with their own
    turns after their first `first`: (turns (conv, pos, x, words), conversations (conv, len))."""
    sizes = own.groupBy("conv").agg(F.max("pos").alias("n")).withColumns({"base": base, "first": first})
    lent = F.least(F.col("first").cast("long"), F.coalesce("n_base", F.lit(0)))
    convs = sizes.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base")), "base", "left").withColumn("lent", lent)
    convs = cut(convs.select("conv", "base", "first", "lent", (F.col("lent") + F.greatest(F.col("n") - F.col("first"), F.lit(0))).alias("len")), "conversations")
    lead = own.where(F.col("pos") <= most).select(F.col("conv").alias("base"), "pos", "x", "words")
    borrowed = convs.join(lead, "base").where("pos <= first").select("conv", "pos", "x", "words")
    rest = own.join(convs.select("conv", "first", "lent"), "conv").where("pos > first").select("conv", (F.col("pos") - F.col("first") + F.col("lent")).alias("pos"), "x", "words")
    return borrowed.union(rest), convs.select("conv", "len")


def _key(depth: Column, *sums: Column) -> Column:
    return F.concat_ws(":", depth.cast("string"), *(s.cast("decimal(38,0)").cast("string") for s in sums))


def memberships(told: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, node, parent, words, len): every conversation's nodes, the root included."""
    digest = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), "x"), 256)
    number = lambda k: F.conv(F.substring(digest, 15 * k + 1, 15), 16, 10).cast("decimal(38,0)")
    summed = running(told.withColumns({f"g{i}": number(i) for i in range(len(SUMS))}), ["conv"], ["pos"], {s: F.col(f"g{i}") for i, s in enumerate(SUMS)}, cut)
    above = (F.col(s) - F.col(f"g{i}") for i, s in enumerate(SUMS))
    each = summed.select("conv", F.col("pos").alias("depth"), _key(F.col("pos"), *(F.col(s) for s in SUMS)).alias("node"), _key(F.col("pos") - 1, *above).alias("parent"), "words")
    root = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("words"))
    return cut(each.union(root).join(convs, "conv"), "memberships")


def ends(members: DataFrame) -> DataFrame:
    """(node, ends_sha256): of each node where conversations end, the digest of their ids, ascending and joined by commas."""
    last = members.where("depth = len").select("node", "conv").repartition("node").sortWithinPartitions("node", "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            done: list[tuple[str, str]] = []
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k != node:
                    if state:
                        done.append((node, state.hexdigest()))
                    node, state = k, hashlib.sha256(str(c).encode())
                else:
                    state.update(f",{c}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (zip(*done, strict=True) if done else ((), ()))], ["node", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    return last.mapInArrow(run, "node string, ends_sha256 string")


def path_totals(paths: DataFrame) -> DataFrame:
    """paths (lead, above: the lead of the path it hangs from, null for the root's; at: the node it hangs from; leaves,
    saved: its own) -> (at, leaves, saved) of every path but the root's, with all that hangs from it."""
    hanging = paths.where("above is not null").groupBy(F.col("above").alias("lead")).agg(F.count("*").alias("waits"))
    pending = cut(paths.join(hanging, "lead", "left").withColumn("waits", F.coalesce("waits", F.lit(0))), "paths")
    told = []
    while True:
        complete = pending.where("waits = 0 and above is not null").select("at", "above", "leaves", "saved")
        told.append(complete.select("at", "leaves", "saved"))
        rest = pending.where("waits > 0")
        if rest.isEmpty():  # the root's path has got all its messages
            break
        sent = complete.groupBy(F.col("above").alias("lead")).agg(F.count("*").alias("k"), F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        got = lambda c: F.coalesce(c, F.lit(0))
        pending = cut(rest.join(sent, "lead", "left").select("lead", "above", "at", (F.col("leaves") + got("more_leaves")).alias("leaves"), (F.col("saved") + got("more_saved")).alias("saved"), (F.col("waits") - got("k")).alias("waits")), "paths")
    return reduce(DataFrame.union, told)


def trie(told: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node. told
    (conv, pos, x, words): conversations' turns by places from 1 without gaps; convs (conv, len): all of them."""
    members = memberships(told, convs)
    lead = F.max(F.struct("len", (-F.col("conv")).alias("c")))
    nodes = members.groupBy("node").agg(F.min("depth").alias("depth"), F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"), F.min("parent").alias("parent"), lead.alias("lead"))
    nodes = cut(nodes.select("node", "parent", "depth", "conv_id", "n_convs", (-F.col("lead.c")).alias("lead"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    over = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("lead").alias("above"))
    linked = cut(nodes.join(over, "parent", "left"), "linked")

    head = F.min_by(F.struct("above", F.col("parent").alias("at")), "depth")
    paths = linked.groupBy("lead").agg(head.alias("head"), F.sum("saved").alias("saved"), F.lit(1).cast("long").alias("leaves"))
    hung = path_totals(paths.select("lead", "head.above", "head.at", "leaves", "saved"))
    hung = hung.groupBy(F.col("at").alias("node")).agg(F.sum("leaves").alias("hung_leaves"), F.sum("saved").alias("hung_saved"))

    none = F.lit(0).cast("long")
    full = linked.join(children, "node", "left").join(hung, "node", "left").join(ends(members), "node", "left")
    leaf = F.when(F.col("n_children").isNull(), 1).otherwise(0)
    sums = {"n_leaves": leaf + F.coalesce("hung_leaves", none), "saved_tokens": F.col("saved") + F.coalesce("hung_saved", none)}
    # from the end of a path up: the order is that of falling depths
    summed = running(full.withColumn("up", -F.col("depth")), ["lead"], ["up"], sums, cut)
    return summed.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", none).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
