"""Language identification: multinomial naive Bayes over hashed character n-grams.

fit() counts n-grams of a bounded, stratified sample of labelled rows on the executors and keeps one
log-probability matrix (buckets x languages); predict() broadcasts it and scores batches in numpy: the hashed
n-grams of a slice of texts are looked up together and summed by text.

Defined results: a null text or one without a letter is `und` with score 0; an empty table gives an empty result;
with no labelled rows every text is `und`; repeated rows are predicted each by itself; a tie goes to the language
that sorts first. Only the id and text columns are read, so further columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchledger.llm.common import map_arrow, mix, slices

LETTER = regex.compile(r"\p{L}")  # of the letter categories: not ½, ², ① or Ⅷ


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    log_p: np.ndarray  # (buckets, languages), float32
    sizes: tuple[int, ...]


def ngrams(texts: list[str], sizes: tuple[int, ...], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: (bucket of every n-gram of the texts, first of each text). Texts are lower-cased and framed by spaces; n-grams never span two texts."""
    framed = [f" {t.lower()} " for t in texts]
    code = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.array([len(t) for t in framed])
    start = np.concatenate(([0], np.cumsum(length)[:-1]))
    for n in sizes:
        h = np.full(max(len(code) - n + 1, 0), n, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + code[i : len(code) - n + 1 + i]
        bucket = (mix(h) & np.uint64(buckets - 1)).astype(np.int64)
        keep = np.ones(len(bucket), bool)
        for i in range(1, n):  # those that reach into the next text
            cut = start[1:] - i
            keep[cut[(cut >= 0) & (cut < len(keep))]] = False
        per = np.maximum(length - n + 1, 0)
        yield bucket[keep], np.concatenate(([0], np.cumsum(per)))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", per_lang: int = 2000, sizes: tuple[int, ...] = (1, 2, 3), buckets: int = 1 << 16, smooth: float = 0.5, seed: int = 7) -> Model:
    """Learn from about per_lang rows of each language (all rows of rarer ones), chosen by a hash of the text."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    share = rows.groupBy("lang").agg((F.lit(float(per_lang)) / F.count("*")).alias("share"))
    unit = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.join(F.broadcast(share), "lang").where(unit < F.col("share")).select("lang", "text")  # share has a row for each language

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, texts = (batch.column(x).to_pylist() for x in ("lang", "text"))
        got: dict[str, np.ndarray] = {}
        for i, j in slices(texts):
            for bucket, first in ngrams(texts[i:j], sizes, buckets):
                of = np.array(langs[i:j], object)
                for name in set(langs[i:j]):
                    mask = np.repeat(of == name, np.diff(first))
                    got[name] = got.get(name, 0) + np.bincount(bucket[mask], minlength=buckets)
        names = [k for k in got for _ in range(np.count_nonzero(got[k]))]
        at = [np.flatnonzero(v) for v in got.values()]
        return pa.RecordBatch.from_pydict({"lang": names, "bucket": np.concatenate(at), "n": np.concatenate([v[a] for v, a in zip(got.values(), at, strict=True)])})

    counts = map_arrow(sample, count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))

    def dense(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.bincount(pdf["bucket"], weights=pdf["n"], minlength=buckets).astype(np.float32)
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "counts": [v.tobytes()]})

    # a vector of `buckets` numbers for each language comes to the driver
    got = sorted(counts.groupBy("lang").applyInPandas(dense, "lang string, counts binary").collect())
    m = np.array([np.frombuffer(r["counts"], np.float32) for r in got], np.float64).reshape(len(got), buckets) + smooth
    return Model(tuple(r["lang"] for r in got), np.log(m / m.sum(axis=1, keepdims=True)).T.astype(np.float32).copy(), sizes)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id_col, lang_pred, score: the posterior of the predicted language under even priors."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages floats
    kind = dict(docs.select(id_col).dtypes)[id_col]

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        texts = [t or "" for t in batch.column("text").to_pylist()]
        pred, conf = np.full(len(texts), "und", object), np.zeros(len(texts))
        for i, j in slices(texts) if m.langs else ():
            total = np.zeros((j - i, len(m.langs)))
            for bucket, first in ngrams(texts[i:j], m.sizes, len(m.log_p)):
                sums = m.log_p[bucket]
                full = np.flatnonzero(np.diff(first))
                if len(full):
                    total[full] += np.add.reduceat(sums, first[full], axis=0, dtype=np.float64)
            p = np.exp(total - total.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            pred[i:j], conf[i:j] = np.array(m.langs, object)[best], p.max(axis=1)
        for k, t in enumerate(texts):
            if not LETTER.search(t):
                pred[k], conf[k] = "und", 0.0
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(pred, pa.string()), pa.array(conf)], ["id", "lang_pred", "score"])

    got = map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), score, f"id {kind}, lang_pred string, score double")
    return got.withColumnRenamed("id", id_col)
