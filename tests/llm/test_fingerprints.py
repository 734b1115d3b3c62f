from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from matchledger.llm import fingerprints as fp
from matchledger.llm.common import Words, mix


def jaccard(a, b, k=5):
    def grams(t):
        w = t.lower().split()
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}

    return len(grams(a) & grams(b)) / len(grams(a) | grams(b))


def test_likeness_estimates_jaccard():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(800)]
    for share in (0.0, 0.1, 0.3, 0.9):
        other = base[: int(800 * (1 - share))] + [rng.choice(words) for _ in range(int(800 * share))]
        (low, has) = fp.sketch([" ".join(base), " ".join(other)])
        got = fp.likeness(low[:1], low[1:], has[:1], has[1:])[0]
        assert got == pytest.approx(jaccard(" ".join(base), " ".join(other)), abs=0.12)
    low, has = fp.sketch(["short text", "short text", "other words here", "", None or ""])
    assert fp.likeness(low[:1], low[1:2], has[:1], has[1:2])[0] == 1
    assert fp.likeness(low[:1], low[2:3], has[:1], has[2:3])[0] < 0.2
    assert fp.likeness(low[:1], low[3:4], has[:1], has[3:4])[0] == 0
    assert fp.likeness(low[3:4], low[4:], has[3:4], has[4:])[0] == 1
    assert set(fp.pack(low)[3]) == {"0"} and len(fp.pack(low)[0]) == 256


def one_by_one(text, bins=fp.BINS, bits=fp.BITS, k=fp.SHINGLE):
    """A text's low bits, bin by bin: the least remainder of the hashes that fall there, else that of the first full bin that its attempts name."""
    word = {}
    tokens = re.findall(r"[^\W_]+", text.lower())
    for w in tokens:
        word[w] = int(Words([w]).hash[0])
    m64 = (1 << 64) - 1
    one = lambda x: int(mix(np.array([x & m64], np.uint64))[0])
    held = {}
    for i in range(max(len(tokens) - k + 1, min(len(tokens), 1))):
        h = 0
        for w in tokens[i : i + k]:
            h = one(h * 0x9E3779B97F4A7C15 + word[w])
        at, rest = h >> (64 - 8), h & ((1 << 56) - 1)
        held[at] = min(rest, held.get(at, rest))
    if not held:
        return [0] * bins
    out = []
    for b in range(bins):
        at, attempt = b, 0
        while at not in held:
            attempt += 1
            at = one(b + attempt * 0x9E3779B97F4A7C15) % bins
        out.append(one(held[at]) & ((1 << bits) - 1))
    return out


def test_sketch_against_one_by_one():
    rng = random.Random(3)
    texts = ["", "one", "a b c d", " ".join(f"w{rng.randrange(60)}" for _ in range(300)), " ".join(f"x{i}" for i in range(4000)), "same line of five words " * 50]
    low, has = fp.sketch(texts)
    assert has.tolist() == [False] + [True] * 5
    for t, row in zip(texts, low.tolist(), strict=True):
        assert row == one_by_one(t)


def test_more_partitions_than_rows(spark, docs):
    """Partitions without rows are skipped when the next text is looked up, and the last is followed by the first."""
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        rows = [(i * 10, f"text number {i} has some words of its own") for i in range(6)] + [(10, "text number 1 again")]
        got = fp.with_next(docs(rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert len(got) == 7
    for r in got:
        if r["doc_id"] not in (0, 10):
            t, nxt = rows[r["doc_id"] // 10][1], rows[(r["doc_id"] // 10 + 1) % 6][1]
            q = len(t) // 4
            edited = t[: len(t) - q] + nxt[:q]
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            (a, ha), (e, he) = fp.sketch([t]), fp.sketch([edited])
            assert r["near_edited"] == pytest.approx(fp.likeness(a, e, ha, he)[0]) and r["edited_fingerprint"] == fp.pack(e)[0]


def test_pack_is_big_endian():
    assert fp.pack(np.array([[1, 15, 0, 10]], np.uint8)) == ["1f0a"]


def test_with_next_takes_the_next_id(spark, docs):
    rng = random.Random(2)
    rows = [(i * 7 % 101, " ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randint(0, 40))) if i else None) for i in range(101)]
    got = {r["doc_id"]: r for r in fp.with_next(docs(rows).repartition(5)).collect()}
    order = sorted(rows)
    for (k, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        t, nxt = t or "", nxt or ""
        q = len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        assert got[k]["n_chars"] == len(t)
        assert got[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        (a, ha), (b, hb) = fp.sketch([t]), fp.sketch([nxt])
        assert got[k]["fingerprint"] == fp.pack(a)[0]
        assert got[k]["near_next"] == pytest.approx(fp.likeness(a, b, ha, hb)[0])


def test_one_row_none_and_repeats(spark, docs):
    assert fp.with_next(docs([])).count() == 0
    (r,) = fp.with_next(docs([(1, "añb c d e f g h")])).collect()
    assert r["n_chars"] == 15 and r["near_next"] == 1
    got = fp.with_next(docs([(1, "x y"), (1, "x y"), (None, "z")])).collect()
    assert sorted((r["doc_id"] or 0) for r in got) == [0, 1, 1]
    assert len({r["fingerprint"] for r in got if r["doc_id"]}) == 1
    assert fp.fingerprint(docs([(1, "x y"), (2, None)])).count() == 2
