from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchledger.llm import langid, toxicity
from matchledger.llm.common import Words, shingle_hashes
from matchledger.llm.queries import op1_toxicity, op7_language_id

D = "/root/testdata/sf0.01"


def test_words_hash_by_content():
    w = Words(["Ab wörd ab", "", "x-ab  WÖRD"])
    assert w.count.tolist() == [3, 0, 3]
    assert w.hash[0] == w.hash[2] == w.hash[4] and w.hash[1] == w.hash[5] and w.hash[0] != w.hash[1]
    h, first = shingle_hashes(Words(["a b c", "a b", "", "z a b c"]), 3)
    assert first.tolist() == [0, 1, 2, 2, 4] and h[0] == h[3] and len(set(h.tolist())) == 3


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    first = np.array([0, 5, 5, 6, 14])
    emit, chain = rng.normal(size=14), np.exp(rng.normal(size=(2, 2)))
    p = toxicity.forward_backward(emit, first, chain)[2]
    for s, e in itertools.pairwise(first):
        total, ones = 0.0, np.zeros(e - s)
        for y in itertools.product((0, 1), repeat=int(e - s)):
            v = np.exp(sum(emit[s + i] for i, k in enumerate(y) if k)) * np.prod([chain[a, b] for a, b in itertools.pairwise(y)])
            total, ones = total + v, ones + v * np.array(y)
        if e > s:
            assert np.allclose(p[s:e], ones / total)


def likelihood(ids, y, first, own, weight, bias, log_chain):
    """By enumeration of all states of each sequence."""
    out = 0.0
    for s, e in itertools.pairwise(first):
        def value(states):
            v = 0.0
            for i, k in enumerate(states):
                at = s + i
                near = [(0, ids[0][at]), (1, ids[1][at]), *([(2, ids[0][at - 1])] if i else []), *([(3, ids[0][at + 1])] if at + 1 < e else [])]
                v += k * (bias + sum(weight[row][col] for row, col in near)) + (log_chain[states[i - 1], k] if i else 0.0)
            return v
        if e > s:
            every = [value(z) for z in itertools.product((0, 1), repeat=int(e - s))]
            out += own[s] * (value([int(k) for k in y[s:e]]) - math.log(sum(map(math.exp, every))))
    return out


def test_gradient_against_finite_differences():
    rng = np.random.default_rng(4)
    first, n, words = np.array([0, 4, 4, 5, 11]), 11, 3
    ids = rng.integers(0, words + 1, (2, n))
    y = rng.integers(0, 2, n).astype(float)
    own = np.repeat([1.0, 2.5, 0.5, 3.0], np.diff(first))
    weight, bias, log_chain = rng.normal(size=(4, words + 1)), 0.3, rng.normal(size=(2, 2))
    grad = toxicity.gradient(ids, y, first, own, weight, bias, log_chain)
    step = 1e-5
    for got, at in ((grad[0], weight), (grad[1], log_chain)):
        for k in np.ndindex(at.shape):
            at[k] += step
            up = likelihood(ids, y, first, own, weight, bias, log_chain)
            at[k] -= 2 * step
            down = likelihood(ids, y, first, own, weight, bias, log_chain)
            at[k] += step
            assert abs(got[k] - (up - down) / (2 * step)) < 1e-6
    up, down = (likelihood(ids, y, first, own, weight, bias + d, log_chain) for d in (step, -step))
    assert abs(grad[2] - (up - down) / (2 * step)) < 1e-6


def test_score_against_enumeration(spark, docs):
    """Scores of short texts: marginals over all states, the document's features, the logistic function; by hand."""
    learn = [(i, ("you idiot go away now " if i % 2 else "what a calm and sunny day ") * 2 + f"w{i}") for i in range(40)]
    model = toxicity.fit(docs(learn), spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"))
    texts = ["you idiot", "a calm day", "go Away, idiot idiot now", "", "sunny idiot", "x y z", "you you you you you"]
    for r in toxicity.score(docs(list(enumerate(texts))), model).collect():
        w = Words([texts[r["doc_id"]].lower()])
        n = int(w.count[0])
        index = {int(h): k + 1 for k, h in enumerate(model.vocab)}
        word, prefix = ([index.get(int(h), 0) for h in hs] for hs in toxicity.features(w))
        emit = [model.bias + model.weight[0][word[i]] + model.weight[1][prefix[i]] + (model.weight[2][word[i - 1]] if i else 0) + (model.weight[3][word[i + 1]] if i + 1 < n else 0) for i in range(n)]
        total, ones = 0.0, np.zeros(n)
        for states in itertools.product((0, 1), repeat=n):
            v = math.exp(sum(e for e, k in zip(emit, states) if k)) * math.prod(model.chain[a, b] for a, b in itertools.pairwise(states))
            total, ones = total + v, ones + v * np.array(states)
        p = ones / total
        x = [1.0, p.max(initial=0), math.log1p((p * p).sum()), math.log1p(n)] if n else [1.0, 0, 0, 0]
        assert abs(r["score"] - 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.doc))))) < 1e-9


def test_scan_over_many_lanes():
    rng = np.random.default_rng(1)
    a, b, c, d = rng.random((4, 30000)) + 0.01
    r, want = 1.0, []
    for t in range(30000):
        r = (a[t] * r + b[t]) / (c[t] * r + d[t])
        want.append(r)
    assert np.allclose(toxicity.scan(a, b, c, d), want)


def test_toxicity_held_out(spark):
    got = op1_toxicity(spark, D)
    assert got.count() == spark.read.parquet(f"{D}/documents.parquet").count()
    seen = got.where("held_out").join(spark.read.parquet(f"{D}/labels.parquet"), "doc_id").select("toxic", "predicted", "score").collect()
    right = [r["toxic"] == r["predicted"] for r in seen]
    assert sum(right) / len(right) > 0.9
    toxic = [r for r in seen if r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.6 * len(toxic)
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_toxic_offsets_and_edges(spark, docs):
    rows = [(i, ("Ärger! you IDIOT, é fine " if i % 2 else "a calm and sunny day ") * 3 + f"n{i} " * 9) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs(rows), labels, per_class=100)
    more = [(100, rows[1][1]), (101, None), (102, ""), (None, "x"), (100, rows[1][1]), (103, "word " * 50000)]
    got = toxicity.score(docs(more), model).collect()
    hit = next(r for r in got if r["doc_id"] == 100)
    assert hit["score"] > 0.5 and "IDIOT" in rows[1][1][hit["spans"][0]["start"] : hit["spans"][0]["end"]]
    assert len(got) == 6 and all(r["score"] < 0.5 for r in got if r["doc_id"] != 100)
    kept = toxicity.keep_below(docs(more), model, 0.5)
    assert kept.columns == docs(more).columns and kept.count() == 4
    assert toxicity.fit(docs([]), labels) is None
    assert toxicity.score(docs(more), None).agg(F.max("score")).first()[0] == 0
    assert toxicity.score(docs([]), model).count() == 0


def test_language_held_out(spark):
    got = op7_language_id(spark, D)
    right = got.where("held_out").join(spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_against_counts_by_hand(spark, docs):
    """Posteriors of naive Bayes with n-grams counted one by one."""
    train = [(1, "The cat sat.", "en"), (2, "A dog ran", "en"), (3, "Die Katze saß", "de"), (4, "le chat", "fr")]
    buckets, sizes, smooth = 1 << 16, (1, 2, 3), 0.5

    def grams(t):
        t = f" {t.lower()} "
        return [t[i : i + n] for n in sizes for i in range(len(t) - n + 1)]

    counts = {lang: Counter(g for _, t, own in train if own == lang for g in grams(t)) for lang in ("de", "en", "fr")}
    asked = {10: "the dog sat", 11: "katze und hund", 12: "chat", 13: "x"}
    model = langid.fit(docs([(i, t, lang, "a") for i, t, lang in train]), sizes=sizes, buckets=buckets, smooth=smooth)
    for r in langid.predict(docs(list(asked.items())), model).collect():
        log_p = {lang: sum(math.log((c[g] + smooth) / (c.total() + smooth * buckets)) for g in grams(asked[r["doc_id"]])) for lang, c in counts.items()}
        best = max(sorted(log_p), key=log_p.get)
        assert r["lang_pred"] == best and r["score"] == pytest.approx(1 / sum(math.exp(v - log_p[best]) for v in log_p.values()), rel=1e-3)


def test_language_edges(spark, docs):
    train = docs([(1, "the cat and the dog", "en", "a"), (2, "der hund und die katze", "de", "a"), (3, None, "fr", "a"), (4, "le chat", None, "a")])
    model = langid.fit(train)
    assert model.langs == ("de", "en")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs([(1, None), (2, ""), (3, "123 !"), (4, "the dog"), (5, "der die und"), (6, "the " * 60000)]), model).collect()}
    assert got == {1: "und", 2: "und", 3: "und", 4: "en", 5: "de", 6: "en"}
    assert langid.predict(docs([]), model).count() == 0
    none = langid.fit(docs([]))
    assert [r["lang_pred"] for r in langid.predict(docs([(1, "abc")]), none).collect()] == ["und"]


def test_toxicity_keeps_the_odds_of_the_classes(spark, docs):
    """Texts that tell nothing score as often as their class occurs, whether all labels are learned from or a sample."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(20))) for i in range(1600)]
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(1600)], "doc_id long, toxic int")
    for per_class in (2000, 100):
        model = toxicity.fit(docs(rows), labels, per_class=per_class)
        assert toxicity.score(docs(rows), model).agg(F.avg("score")).first()[0] == pytest.approx(0.125, abs=0.05)


def test_numbers_are_no_letters(spark, docs):
    """Characters that are numeric but of no letter category leave a text without a letter."""
    model = langid.fit(docs([(1, "hello there", "en", "a"), (2, "bonjour", "fr", "a")]))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs([(1, "½ ² ① Ⅷ 12 _"), (2, "ª")]), model).collect()}
    assert got[1] == ("und", 0.0) and got[2][0] in ("en", "fr")
