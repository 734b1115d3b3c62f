from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from matchledger.llm import near_sets, simhash
from matchledger.llm.components import components


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def reference_fingerprint(text, k):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").split(" ") if w]
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_fingerprint_by_definition():
    texts = ["a b c d e f g", "A  b\tC d", "one two", "", " \n ", "É é  x y z", "w " * 3000]
    assert [int(x) for x in simhash.fingerprint(texts, 4)] == [reference_fingerprint(t, 4) for t in texts]


@pytest.mark.parametrize(("most", "bucket_rows"), [(4, 4096), (4, 2), (3, 2)])
def test_links_against_all_pairs(spark, most, bucket_rows):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for base in list(fps)[:6]:  # clusters and chains
        for _ in range(12):
            x = rng.choice([base, *fps])
            for _ in range(rng.randint(1, most + 2)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(simhash.signed(x) for x in fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.links(df, most, bucket_rows)).collect()}
    want = brute_components(fps, lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= most)
    assert {f: got.get(f, f) for f in fps} == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 40)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {1000 + i: 1000 for i in range(40)}


def test_cluster_and_keep_one(spark, docs):
    rows = [(5, "same words here now ok"), (3, "Same words, here now ok"), (3, "same words here now ok"), (9, None), (2, "  "), (4, "another text entirely of its own"), (4, "another text entirely of its own"), (None, "x y z"), (None, "x y z")]
    got = {(r["doc_id"], r["component_id"]) for r in simhash.cluster(docs(rows)).collect()}
    assert got == {(5, 3), (3, 3), (9, 2), (2, 2), (4, 4), (None, None)}  # the comma makes another text of 3, which is a component of its own id
    kept = near_sets.keep_one(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, 2, 3, 4]


def shingle_set(text, k=5):
    w = text.lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def near_rows(seed, groups, copies, words=220):
    """Groups of near copies (a few words changed) and lone documents."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(groups):
        base = [rng.choice(vocab) for _ in range(words)]
        for c in range(copies if g % 2 else 1):
            t = list(base)
            for _ in range(rng.randint(0, 4) if c else 0):
                t[rng.randrange(words)] = rng.choice(vocab)
            rows.append((len(rows), " ".join(t)))
    return rows


@pytest.mark.parametrize(("groups", "copies"), [(40, 4), (1200, 3)])
def test_near_groups_against_all_pairs(spark, docs, groups, copies):
    rows = near_rows(7, groups, copies)
    got = {r["id"]: r["component_id"] for r in near_sets.near_groups(docs(rows)).collect()}
    sets = {k: shingle_set(t) for k, t in rows}
    similar = lost = 0
    for a, b in zip(rows, rows[1:] + rows[:1], strict=True):  # copies stand side by side
        x, y = sets[a[0]], sets[b[0]]
        j = len(x & y) / len(x | y)
        if j >= 0.8:
            similar += 1
            lost += got[a[0]] != got[b[0]]
        if j < 0.4:
            assert got[a[0]] != got[b[0]]
    assert similar > groups / 2 and lost <= 0.03 * similar


def test_a_repeated_line_counts_once(spark, docs):
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    line, first, second, third = text(12), text(150), text(150), text(150)
    rows = [(1, f"{first} {line} " + f"{line} " * 200), (2, f"{second} {line} " + f"{line} " * 200), (3, f"{third} {line} {line}"), (4, f"{third} " + f"{line} " * 200)]
    assert len(shingle_set(rows[0][1]) & shingle_set(rows[1][1])) < 0.1 * len(shingle_set(rows[0][1]) | shingle_set(rows[1][1]))
    assert shingle_set(rows[2][1]) <= shingle_set(rows[3][1])
    got = {r["id"]: r["component_id"] for r in near_sets.near_groups(docs(rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 3}


def test_split_blocks_lose_no_link(spark, docs):
    """Chains of which only neighbours are alike, and texts that share two thirds: buckets are split into parts of a few rows."""
    rng = random.Random(2)
    text = lambda n: [f"w{rng.randrange(10**5)}" for _ in range(n)]
    rows = []
    for _ in range(6):
        t = text(200)
        for k in range(12):
            rows.append((len(rows), " ".join(t)))
            t = [*t[18:], *text(18)] if k % 2 else [*text(18), *t[:-18]]
    frame = text(160)
    rows += [(len(rows) + i, " ".join(frame + text(60))) for i in range(40)]
    base = rows[-1][1].split()
    for i in range(40):
        rows.append((len(rows), " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])))
    sets = {k: shingle_set(t) for k, t in rows}
    want = brute_components(sorted(sets), lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    for part_rows in (3, 4096):
        assert {r["id"]: r["component_id"] for r in near_sets.near_groups(docs(rows), part_rows=part_rows).collect()} == want


def test_recall_at_the_threshold():
    """Sets alike by 0.8: of 2,000 pairs at most 1 % share no key or differ in more bits than are allowed."""
    rng = np.random.default_rng(4)
    a, b = [], []
    for _ in range(2000):
        n = int(rng.integers(2, 40)) * 9  # 8/10 of the union in common: 8n/9 of each n
        h = rng.integers(0, 2**64, n + n // 9, dtype=np.uint64)
        a.append(np.sort(h[:n]))
        b.append(np.sort(h[n // 9 :]))
    each = []
    for sets in (a, b):
        first = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
        each.append((near_sets.band_keys(np.concatenate(sets), first), near_sets.simhash(np.concatenate(sets), first)))
    met = (each[0][0] == each[1][0]).any(axis=1)
    apart = np.bitwise_count(each[0][1] ^ each[1][1]).sum(axis=1)
    assert (met & (apart <= near_sets.MOST)).mean() >= 0.99


def test_near_groups_are_those_of_all_sets(spark, docs):
    """Pairs on both sides of 0.8, lone ones and a group large enough for lead links."""
    rng = random.Random(11)
    text = lambda n: [f"w{rng.randrange(10**5)}" for _ in range(n)]
    rows = []
    for g in range(260):
        base = text(rng.choice((60, 150, 240)))
        other = base[: len(base) - (cut := int(len(base) * rng.uniform(0.02, 0.25)))] + text(cut)
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(other))]
    base = text(200)
    for _ in range(60):
        t = list(base)
        t[rng.randrange(200)] = f"x{rng.randrange(10**5)}"
        rows.append((len(rows), " ".join(t)))
    sets = {k: shingle_set(t) for k, t in rows}
    want = brute_components(sorted(sets), lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    assert 80 < sum(want[k] != k for k in range(520)) < 220 and want[579] == 520
    assert {r["id"]: r["component_id"] for r in near_sets.near_groups(docs(rows)).collect()} == want


def test_empty_table(spark, docs):
    assert simhash.cluster(docs([])).count() == 0 == near_sets.keep_one(docs([])).count()


def test_query_over_documents(spark):
    from matchledger.llm.queries import op2_simhash

    d = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    fps = {k: reference_fingerprint(t, 4) for k, t in texts.items()}
    want = brute_components(sorted(fps), lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= 4)
    got = op2_simhash(spark, d)
    assert got.schema.simpleString() == "struct<doc_id:bigint,fingerprint:string,component_id:bigint>"
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got.collect()} == {k: (f"{fps[k]:016x}", want[k]) for k in fps}
    assert got.where(F.col("doc_id") != F.col("component_id")).count() > 0
