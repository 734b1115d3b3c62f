"""The manifest against a plain tree in Python: proofs, folded roots and tampered rows, over groups of many sizes."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from matchledger.llm import merkle, queries
from matchledger.llm.merkle import FIELDS


def h(x: str) -> str:
    return sha256(x.encode()).hexdigest()


def coded(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[int, list[str]]]]]:
    """(root, the way of each node: its place and run, level by level)."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for w, p in zip(ways, at):
            w.append((p % 8, runs[p // 8]))
        at, nodes = [p // 8 for p in at], [h("".join(r)) for r in runs]
    return nodes[0], ways


def brute(rows):
    """rows of FIELDS -> (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    leaves = [h("".join(map(coded, r))) for r in rows]
    order = lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaves[i])
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in langs:
        own = sorted((i for i in range(len(rows)) if rows[i][2] == g), key=order)
        trees[g] = own, *climb([leaves[i] for i in own])
    root, over = climb([trees[g][1] for g in langs])
    for g, way_up in zip(langs, over):
        own, subroot, ways = trees[g]
        for i, way in zip(own, ways):
            r, way = rows[i], way + way_up
            f = leaves[i]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                f = h("".join(map(coded, (*r[:4], "".join(c.lower() if c.isascii() else c for c in r[4])))))
            for p, run in way:
                f = h("".join([*run[:p], f, *run[p + 1 :]]))
            yield r[0], leaves[i], subroot, root, h("".join(d for p, run in way for k, d in enumerate(run) if k != p)), f, f == root


def made(sizes, seed=1):
    rnd, k = random.Random(seed), 0
    for lang, n in sizes.items():
        for _ in range(n):
            k += rnd.choice([1, 1, 7])
            yield (k, rnd.choice([None, "web", ""]), lang, rnd.choice([None, 5]), rnd.choice([None, "", "abc", "ABC é", "x" * 999 + "Z"]))


SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def got(spark, rows, tmp_path, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    return sorted(map(tuple, queries.op11_merkle(spark, str(tmp_path)).collect()), key=repr)


@pytest.mark.parametrize("sizes", [{"en": 700, None: 65, "de": 8, "é": 1, "": 9, "zz": 64}, {"en": 1}, {"en": 9}, {f"l{i:02d}": 1 + i % 3 for i in range(20)}])
def test_equals_a_plain_tree(spark, tmp_path, sizes):
    rows = list(made(sizes))
    assert got(spark, rows, tmp_path) == sorted(brute(rows), key=repr)


def test_repeated_rows_null_ids_and_clashing_names(spark, tmp_path):
    rows = [*made({"en": 30}), (5, "web", "en", 1, "A"), (5, "web", "en", 1, "A"), (5, "web", "en", 1, "B"), (None, None, "en", None, "C"), (None, None, None, None, None)]
    wide = [(*r, 1, "x") for r in rows]
    assert got(spark, wide, tmp_path, SCHEMA + ", digest int, grp string") == sorted(brute(rows), key=repr)


def test_empty_table(spark, tmp_path):
    assert got(spark, [], tmp_path) == []


def test_frontiers_of_scattered_leaves(spark):
    """Leaves dealt at random: nearly nothing completes before frontiers are shuffled."""
    n = 8**3 + 5
    digests = [sha256(str(i).encode()).digest() for i in range(n)]
    leaves = spark.createDataFrame([("g", n, i, d) for i, d in enumerate(digests)], "grp string, n long, pos long, digest binary").repartition(7, F.rand(3))
    nodes, roots = merkle.tree(leaves)
    assert roots.collect()[0]["digest"].hex() == climb([d.hex() for d in digests])[0]
    assert nodes.count() == sum(merkle.width(n, k) for k in range(1, 5))


def test_fields_and_folding():
    proof = bytes([1, 3]) + b"a" * 32 + b"c" * 32
    assert merkle.fold(b"b" * 32, proof) == merkle.parent(b"a" * 32 + b"b" * 32 + b"c" * 32)
    assert merkle.siblings(proof) == (b"a" * 32 + b"c" * 32).hex() and len(FIELDS) == 5
    assert [merkle.width(9, k) for k in range(3)] == [9, 2, 1]
