"""Blocks of near-duplicate buckets: which rows' sets are fetched."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from matchledger.llm import near_sets as ns


def block(fp, keys, comp, part, i=0, j=1):
    n = len(fp)
    cols = {"key": np.full(n, keys[0, 0]), "i": np.full(n, i, np.int32), "j": np.full(n, j, np.int32), "part": np.asarray(part, np.int32), "node": np.arange(n), "comp": np.asarray(comp), "n": np.full(n, 100)}
    cols |= {c: fp[:, k].view(np.int64) for k, c in enumerate(ns.FP)} | {c: keys[:, k] for k, c in enumerate(ns.KEYS)}
    return pa.RecordBatch.from_pydict({k: pa.array(np.ascontiguousarray(v)) for k, v in cols.items()})


def near(*batches):
    return sorted(x for b in ns.near_rows(iter(batches)) for x in b.column("node").to_pylist())


def given(n, seed=3):
    rng = np.random.default_rng(seed)
    keys = rng.integers(1, 2**62, (n, ns.BANDS))
    keys[:, 0] = 7  # all meet in the first band
    return rng.integers(0, 2**64, (n, ns.WORDS), dtype=np.uint64), keys


def test_unlike_rows_fetch_no_sets():
    fp, keys = given(3000)
    part = np.arange(3000) % 2
    assert near(block(fp, keys, np.arange(3000), part)) == []
    fp[11] = fp[4] ^ np.uint64(0b1011)  # parts 1 and 0
    fp[8] = fp[6]  # both of part 0: the block of parts 0 and 1 is not theirs
    assert near(block(fp, keys, np.arange(3000), part)) == [4, 11]
    assert near(block(fp[part == 0], keys[part == 0], np.arange(1500), np.zeros(1500), 0, 0)) == [3, 4]  # rows 6 and 8


def test_near_rows_by_all_pairs():
    rng = np.random.default_rng(8)
    fp, keys = given(200)
    for r in range(100, 200):  # copies of a row with up to 90 bits changed
        flip = np.zeros(256, np.uint8)
        flip[rng.choice(256, rng.integers(0, 90), replace=False)] = 1
        fp[r] = fp[rng.integers(0, 100)] ^ np.packbits(flip).view(np.uint64)
    comp, part = rng.integers(0, 150, 200), rng.integers(0, 2, 200)
    apart = np.bitwise_count(fp[:, None] ^ fp[None]).sum(axis=2)
    meets = (comp[:, None] != comp[None]) & (part[:, None] != part[None]) & (apart <= ns.MOST)
    want = np.flatnonzero(meets.any(axis=1)).tolist()
    whole = block(fp, keys, comp, part)
    assert 20 < len(want) < 200 and near(whole) == want == near(whole.slice(0, 90), whole.slice(90))


def test_links_by_sets_of_all_32_bits():
    """Two sets alike by 0.9, with shingles over 2^31 as well, in one block."""
    rng = np.random.default_rng(2)
    fp, keys = given(2)
    fp[1] = fp[0]
    union = np.sort(rng.choice(2**32, 200, replace=False).astype(np.uint32))
    lists = pa.array([union[:190].view(np.int32).tolist(), union[10:].view(np.int32).tolist()], pa.list_(pa.int32()))
    rows = block(fp, keys, [0, 1], [0, 1]).append_column("shingles", lists)
    got = [b.to_pydict() for b in ns.block_links(iter([rows]))]
    assert got == [{"a": [0], "b": [1]}]
