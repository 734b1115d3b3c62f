"""The pipeline's stages against brute force on the smallest tables."""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from matchledger.llm import mixing, near_sets, toxicity
from matchledger.llm.common import table

D = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_ids"]
    docs = table(spark, D, "documents")

    clean = stages["toxicity"](spark, docs, D).checkpoint()
    model = toxicity.fit(docs, table(spark, D, "labels"))
    want = {r["doc_id"] for r in toxicity.score(docs, model).where("score < 0.5").collect()}
    assert set(rows(clean)) == want and clean.columns == docs.columns

    single = stages["near_duplicates"](spark, clean, D).checkpoint()
    before, after = rows(clean), rows(single)
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for k, w in ((k, words(t)) for k, t in before.items())}
    close = {k: [o for o in before if o < k and len(sets[k] & sets[o]) >= 0.5 * len(sets[k] | sets[o])] for k in before}
    sure = {k for k in before if any(len(sets[k] & sets[o]) >= 0.9 * len(sets[k] | sets[o]) for o in close[k])}
    gone = set(before) - set(after)
    assert sure <= gone and all(close[k] for k in gone) and gone

    fresh = stages["decontamination"](spark, single, D).checkpoint()
    windows = set()
    for r in table(spark, D, "benchmark").collect():
        w = words(r["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(x) for x in windows}
    hit = {k for k, t in after.items() for w in [words(t)] for n in sizes for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows}
    assert set(rows(fresh)) == set(after) - hit and hit

    mixed = stages["mixing"](spark, fresh, D).checkpoint()
    assert set(rows(mixed)) == {r["doc_id"] for r in mixing.decide(fresh).where("kept").collect()} and mixed.columns == docs.columns

    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in stages["token_ids"](spark, mixed, D).collect()}
    for k, t in sorted(rows(mixed).items()):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        assert got[k] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == mixed.count()


def test_stages_take_odd_rows(spark, docs, tmp_path):
    """Nulls, repeats, clashing names and an empty table go through every stage."""
    for name, rows_, schema in (("labels", [(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int"), ("benchmark", [(1, None), (2, "one two three")], "item_id long, text string")):
        spark.createDataFrame(rows_, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    odd = docs([(1, None), (1, ""), (None, "x y"), (None, None), (2, "Same text here, again and again. " * 3), (2, "Same text here, again and again. " * 3), (3, "one two three"), (4, "w " * 3000)])
    for given in (odd, docs([])):
        out = given
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, str(tmp_path)).checkpoint()
            if name == "decontamination":
                assert out.where(F.col("text") == "one two three").count() == 0
        assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_near_duplicates_of_repeated_ids(spark, docs):
    """Rows are told apart by id and text: texts that nobody else has stay, one row of each group is kept."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near_b = b + " one two three"
    got = near_sets.keep_one(docs([(1, a), (5, a), (5, b), (7, c), (7, near_b)])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, a), (5, b), (7, c)]
    odd = [(3, b), (3, near_b), (3, b), (2, None), (2, None), (None, a), (None, a), (9, "")]
    got = near_sets.keep_one(docs(odd)).collect()
    kept = [(r["doc_id"], r["text"]) for r in got]
    assert len(kept) == 4 and kept.count((None, a)) == 2 and kept.count((2, None)) == 1 and sum(k == 3 for k, _ in kept) == 1
    # repeated rows with other columns: the same one in every run
    twice = spark.createDataFrame([(1, a, "x"), (1, a, "y")], "doc_id long, text string, lang string")
    assert len({near_sets.keep_one(twice.repartition(n)).collect()[0]["lang"] for n in (1, 2)}) == 1
