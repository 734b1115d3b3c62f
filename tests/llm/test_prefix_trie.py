"""The trie of conversations against one in Python: shared beginnings, copies, long conversations, nests of prefixes."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from matchledger.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + ts[h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        own = (len(members[k]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        saved[k] = own + sum(saved[x] for x in children[k])
    for k, ms in members.items():
        told = sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()
        yield min(ms), len(k), min(members[k[:-1]]) if k else None, len(ms), len(children[k]), leaves[k], saved[k], told


def same(df, convs):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(brute(convs), key=key)


def query(spark, rows, tmp_path, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(str(tmp_path / "conversations.parquet"))
    return queries.op12_prefix_trie(spark, str(tmp_path))


def test_query_equals_brute_force(spark, tmp_path):
    r, rows = random.Random(2), []
    for c in [*range(0, 90), 5000, 5001, -3]:
        if c in (20, 45):
            continue  # a conversation that others would begin with is absent
        for t in range(r.choice([1, 1, 2, 3, 5, 8, 60 if c == 7 else 4])):
            rows.append((c, r.choice([t, t, None]), r.choice(["user", "assistant", None]), r.choice(["a", "a b", " a\tb\x0bc\xa0d ", None, "", f"{c}"])))
    rows += [(c, t, "user", f"copy {t}") for c in range(6000, 6040) for t in range(6)]
    rows += [(None, 1, "user", "lost"), (3, 0, "user", "a"), (3, 0, "user", "a"), (61, None, None, None)]
    wide = [(*x, 1, "n") for x in rows]
    same(query(spark, wide, tmp_path, SCHEMA + ", depth int, node string"), rebuilt(rows))


def test_nested_conversations_and_a_long_one(spark):
    """Each conversation goes on where the one before ends, in rising and falling order of ids; one is long."""
    convs = {i: [("u", f"t{k}") for k in range(i)] for i in range(1, 12)}
    convs |= {100 - i: [("u", f"t{k}") for k in range(5)] + [("a", f"s{k} x") for k in range(i)] for i in range(1, 9)}
    convs |= {200: [("u", f"t{k}") for k in range(300)], 201: []}
    convs |= {300 + i: [("u", f"t{k}") for k in range(i)] + [("b", f"{i}")] * (12 - i) for i in range(12)}  # a comb
    rows = [(c, k + 1, digest(*t), len(t[1].split())) for c, ts in convs.items() for k, t in enumerate(ts)]
    told = spark.createDataFrame(rows, "conv long, pos long, x string, words long")
    sizes = spark.createDataFrame([(c, len(ts)) for c, ts in convs.items()], "conv long, len long")
    same(prefix_trie.trie(told, sizes), convs)


@pytest.mark.parametrize("rows", [[], [(None, 1, "u", "a")], [(0, None, None, None)]])
def test_small_tables(spark, tmp_path, rows):
    same(query(spark, rows, tmp_path), rebuilt(rows))
