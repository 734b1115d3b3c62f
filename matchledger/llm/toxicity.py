"""Toxic spans by a linear-chain conditional random field.

Labels are given for documents, so token labels come first: a token of a toxic document is toxic if its word is much
commoner in toxic documents than in clean ones, or its first bytes are. A two-state chain (clean, toxic) with
features of the word, its first bytes, the word before and the word after is fitted to these tokens; forward-backward gives each token's marginal. A document's
score is a logistic function of its marginals (the highest, and the sum of squares) and its length, fitted to the document labels.

fit() learns on the driver from at most about 2 * per_class documents of at most max_words words each (documented
bounds); score() broadcasts the model and takes whole texts. The chain of two states is a chain of fractional linear
maps of the ratio of the states, so numpy runs many stretches of it side by side and joins them exactly.

Defined results: a null or wordless text scores as one without toxic tokens; an empty table gives an empty result;
without labels of both classes every score is 0; several labels of one document count as their maximum; repeated
rows are scored each by itself. Only the id and text columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchledger.llm.common import PIECE, Words, map_arrow, slices

LANES = 1024
PREFIX = 4  # bytes


@dataclass(frozen=True)
class Model:
    vocab: np.ndarray  # sorted hashes of known words and prefixes
    weight: np.ndarray  # (4, vocab + 1): of this word, its prefix, the word before, the one after; 0 stands for unknown ones
    bias: float
    chain: np.ndarray  # 2 x 2, exp of the transition scores
    doc: np.ndarray  # bias and weights of the document's features


def scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """r[t] = (a[t] r[t-1] + b[t]) / (c[t] r[t-1] + d[t]), r[-1] = 1; all coefficients are 0 or more, and d or c over 0.

    The sequence is cut into stretches. Each stretch's maps are composed side by side with the other stretches', the
    composed maps give the value at the start of each stretch, and a second pass fills in the values."""
    n = len(a)
    lanes = max(1, min(LANES, n // 8))
    steps = -(-n // lanes)
    pad = lanes * steps - n
    a, b, c, d = (np.concatenate((x, np.full(pad, y))).reshape(lanes, steps).T.copy() for x, y in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0)))
    p, q, r, s = a[0], b[0], c[0], d[0]
    for t in range(1, steps):
        p, q, r, s = a[t] * p + b[t] * r, a[t] * q + b[t] * s, c[t] * p + d[t] * r, c[t] * q + d[t] * s
        scale = 1 / (p + q + r + s)
        p, q, r, s = p * scale, q * scale, r * scale, s * scale
    x = np.empty(lanes)
    x[0] = 1.0
    for k in range(lanes - 1):
        x[k + 1] = (p[k] * x[k] + q[k]) / (r[k] * x[k] + s[k])
    out = np.empty((steps, lanes))
    for t in range(steps):
        x = (a[t] * x + b[t]) / (c[t] * x + d[t])
        out[t] = x
    return out.T.reshape(-1)[:n]


def forward_backward(emit: np.ndarray, first: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ratio of the forward scores, ratio of the backward scores, marginal of state 1). emit: score of state 1 above state 0; first: where each sequence starts, and the end."""
    n = len(emit)
    x = np.exp(np.clip(emit, -30, 30))
    heads = first[:-1][np.diff(first) > 0]
    tails = first[1:][np.diff(first) > 0] - 1
    a, b, c, d = x * chain[1, 1], x * chain[0, 1], np.full(n, chain[1, 0]), np.full(n, chain[0, 0])
    a[heads], b[heads], c[heads], d[heads] = 0.0, x[heads], 0.0, 1.0
    fwd = scan(a, b, c, d)
    nxt = np.concatenate((x[1:], [1.0]))
    a, b, c, d = nxt * chain[1, 1], np.full(n, chain[1, 0]), nxt * chain[0, 1], np.full(n, chain[0, 0])
    a[tails], b[tails], c[tails], d[tails] = 0.0, 1.0, 0.0, 1.0
    bwd = scan(a[::-1], b[::-1], c[::-1], d[::-1])[::-1]
    odds = fwd * bwd
    return fwd, bwd, odds / (1 + odds)


def neighbours(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids before and after each token; -1 (a weight of 0) at the ends of its sequence."""
    before, after = np.concatenate(([-1], ids[:-1])), np.concatenate((ids[1:], [-1]))
    full = np.diff(first) > 0
    before[first[:-1][full]], after[first[1:][full] - 1] = -1, -1
    return before, after


def emission(ids: np.ndarray, first: np.ndarray, weight: np.ndarray, bias: float) -> np.ndarray:
    """ids: (2, tokens), of words and of their prefixes."""
    before, after = neighbours(ids[0], first)
    padded = np.concatenate((weight, np.zeros((4, 1))), axis=1)  # index -1
    return bias + padded[0][ids[0]] + padded[1][ids[1]] + padded[2][before] + padded[3][after]


def features(words: Words) -> np.ndarray:
    return np.array([words.hash, words.prefix_hash(PREFIX)])


def doc_features(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """1, the highest marginal, log(1 + sum of squared marginals), log(1 + words). Squares keep a long text from adding up what every word has."""
    out = np.zeros((len(first) - 1, 4))
    out[:, 0], out[:, 3] = 1, np.log1p(np.diff(first))
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full, 1] = np.maximum.reduceat(p, first[full])
        out[full, 2] = np.log1p(np.add.reduceat(p * p, first[full]))
    return out


def logistic(x: np.ndarray, y: np.ndarray, each: np.ndarray, ridge: float = 0.01, rounds: int = 30) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (each * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (each * (y - p)) - ridge * w)
    return w


def gradient(ids: np.ndarray, y: np.ndarray, first: np.ndarray, own: np.ndarray, weight: np.ndarray, bias: float, log_chain: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Of the log-likelihood of the tokens' states y, each sequence counted `own` times: its derivatives by weight,
    log_chain and bias, which are what is observed less what is expected."""
    emit = emission(ids, first, weight, bias)
    chain = np.exp(log_chain)
    fwd, bwd, p = forward_backward(emit, first, chain)
    g = own * (y - p)
    before, after = neighbours(ids[0], first)
    grad = np.zeros_like(weight)
    for k, v in enumerate((ids[0], ids[1], before, after)):
        grad[k] = np.bincount(v + 1, weights=g, minlength=weight.shape[1] + 1)[1:]
    cur = np.flatnonzero(before >= 0)
    prev = cur - 1
    x = np.exp(np.clip(emit[cur], -30, 30)) * bwd[cur]
    joint = np.array([[np.full(len(cur), chain[0, 0]), chain[0, 1] * x], [fwd[prev] * chain[1, 0], fwd[prev] * chain[1, 1] * x]])
    joint *= own[cur] / joint.sum(axis=(0, 1))
    one, two = y[prev], y[cur]
    seen = np.array([[own[cur] @ ((1 - one) * (1 - two)), own[cur] @ ((1 - one) * two)], [own[cur] @ (one * (1 - two)), own[cur] @ (one * two)]])
    return grad, seen - joint.sum(axis=2), float(g.sum())


def train(tokens: list[np.ndarray], toxic: np.ndarray, each: np.ndarray | None = None, min_docs: int = 3, gap: float = 2.5, epochs: int = 6, rate: float = 0.3, batch: int = 32) -> Model:
    """tokens: for each document its features(); each: for how many documents it stands (1 where none is given)."""
    each = np.ones(len(toxic)) if each is None else each / each.mean()
    count = np.array([t.shape[1] for t in tokens])
    first = np.concatenate(([0], np.cumsum(count)))
    flat = np.concatenate([*tokens, np.zeros((2, 0), np.uint64)], axis=1)
    doc = np.repeat(np.arange(len(tokens)), count)
    vocab, ids = np.unique(flat, return_inverse=True)
    ids = ids.reshape(flat.shape)
    pair = np.unique(doc * np.int64(len(vocab) + 1) + ids)  # in how many documents of each class a feature is
    in_doc, what = pair // (len(vocab) + 1), pair % (len(vocab) + 1)
    pos, all_docs = np.bincount(what[toxic[in_doc] == 1], minlength=len(vocab)), np.bincount(what, minlength=len(vocab))
    n_pos, n_neg = toxic.sum(), len(toxic) - toxic.sum()
    odds = np.log((pos + 0.5) / (n_pos + 1)) - np.log((all_docs - pos + 0.5) / (n_neg + 1))
    known = all_docs >= min_docs
    del flat, pair, in_doc, what
    label = ((odds > gap) & known)[ids].any(axis=0) & (toxic[doc] == 1)
    renumber = np.where(known, np.cumsum(known), 0).astype(np.int32)
    ids, vocab, y = renumber[ids], vocab[known], label.astype(np.float64)
    weight, bias, log_chain = np.zeros((4, len(vocab) + 1)), -3.0, np.zeros((2, 2))
    size = np.full(weight.shape, 1e-6), np.full((2, 2), 1e-6), np.full(1, 1e-6)
    order = np.random.default_rng(5).permutation(len(tokens))
    for _ in range(epochs):
        for part in np.array_split(order, max(1, len(order) // batch)):
            f = np.concatenate(([0], np.cumsum(count[part])))
            at = np.concatenate([np.arange(first[k], first[k + 1]) for k in part] or [np.zeros(0, np.int64)])
            if not len(at):
                continue
            i, t = ids[:, at], y[at]
            told = gradient(i, t, f, np.repeat(each[part], count[part]), weight, bias, log_chain)
            step = told[0] / len(part) - 1e-4 * weight, told[1] / len(part), np.array([told[2] / len(part)])
            for v, s in zip(step, size, strict=True):
                s += v * v
            weight += rate * step[0] / np.sqrt(size[0])
            log_chain += rate * step[1] / np.sqrt(size[1])
            bias += float(rate * step[2][0] / np.sqrt(size[2][0]))
    chain = np.exp(log_chain)
    p = forward_backward(emission(ids, first, weight, bias), first, chain)[2] if first[-1] else np.zeros(0)
    balance = doc_features(p, first)
    return Model(vocab, weight, bias, chain, logistic(balance, toxic.astype(float), each))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", toxic: str = "toxic", allowed: Column | None = None, per_class: int = 2000, max_words: int = 2048, seed: int = 11) -> Model | None:
    """Learn from about per_class labelled documents of each class (those of at most max_words words), chosen by a hash of the id; each counts for all of its class that it stands for, so that scores mean the same at every size. allowed: a condition on the labels' rows. None without rows of both classes."""
    lab = labels.where(allowed) if allowed is not None else labels
    lab = lab.select(F.col(id_col).alias("id"), F.col(toxic).cast("int").alias("toxic")).where("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    share = lab.groupBy("toxic").agg((F.lit(float(per_class)) / F.count("*")).alias("share"))
    unit = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    chosen = lab.join(F.broadcast(share), "toxic").where(unit < F.col("share")).select("id", "toxic", (1 / F.least(F.lit(1.0), "share")).alias("stands"))  # share has two rows
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where("text is not null").join(F.broadcast(chosen), "id")  # about 2 * per_class rows

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, toxic_, stands, texts = (batch.column(x).to_pylist() for x in ("id", "toxic", "stands", "text"))
        out = []
        for i, j in slices(texts):
            w = Words(fold(texts[i:j]), lower=False)
            f = features(w)
            out += [(ids[i + k], toxic_[i + k], stands[i + k], f[:, w.first[k] : w.first[k + 1]].tobytes()) for k in range(j - i) if w.count[k] <= max_words]
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((batch.column("id").type, pa.int32(), pa.float64(), pa.binary()))], ["id", "toxic", "stands", "tokens"])

    got = map_arrow(rows, hashed, f"id {dict(rows.dtypes)['id']}, toxic int, stands double, tokens binary").collect()
    got.sort(key=lambda r: (r["id"], bytes(r["tokens"])))
    y = np.array([r["toxic"] for r in got], np.int64)
    return train([np.frombuffer(r["tokens"], np.uint64).reshape(2, -1) for r in got], y, np.array([r["stands"] for r in got])) if len({*y.tolist()}) == 2 else None


def marginals(words: Words, m: Model) -> np.ndarray:
    h = features(words)
    if not h.shape[1]:
        return np.zeros(0)
    ids = np.searchsorted(m.vocab, h)
    ids = np.where(m.vocab[np.minimum(ids, len(m.vocab) - 1)] == h, ids + 1, 0) if len(m.vocab) else np.zeros(h.shape, np.int64)
    return forward_backward(emission(ids, words.first, m.weight, m.bias), words.first, m.chain)[2]


def toxic_spans(words: Words, p: np.ndarray, least: float) -> list[list[dict]]:
    """For each text its spans of neighbouring toxic words: code point offsets, end exclusive, and the highest marginal."""
    out: list[list[dict]] = [[] for _ in words.count]
    hit = np.flatnonzero(p >= least)
    if not len(hit):
        return out
    begins = np.cumsum(np.concatenate(([0], (words.buf & 0xC0) != 0x80)))  # code points before each byte
    doc = np.searchsorted(words.first, hit, side="right") - 1
    last = -2
    for k, d in zip(hit.tolist(), doc.tolist(), strict=True):
        base = begins[words.at[d]]
        s, e = int(begins[words.start[k]] - base), int(begins[words.end[k]] - base)
        if k == last + 1 and out[d]:
            out[d][-1] |= {"end": e, "p": max(out[d][-1]["p"], float(p[k]))}
        else:
            out[d].append({"start": s, "end": e, "p": float(p[k])})
        last = k
    return out


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """id_col, score, spans array<struct<start,end,p>>: offsets in code points of the text, for tokens whose marginal is at least `least`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    kind = dict(docs.select(id_col).dtypes)[id_col]
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        texts = [t or "" for t in batch.column("text").to_pylist()]
        value, spans = np.zeros(len(texts)), [[] for _ in texts]
        for i, j in slices(texts, 1 << 20) if m else ():
            w = Words(fold(texts[i:j]), lower=False)
            p = marginals(w, m)
            value[i:j] = 1 / (1 + np.exp(-np.clip(doc_features(p, w.first) @ m.doc, -30, 30)))
            spans[i:j] = toxic_spans(w, p, least)
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(value), pa.array(spans, span)], ["id", "score", "spans"])

    got = map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), run, f"id {kind}, score double, spans array<struct<start:int,end:int,p:double>>")
    return got.withColumnRenamed("id", id_col)


def fold(texts: list[str]) -> list[str]:
    """Lower case where that keeps the number of code points (so offsets hold), else the text with A-Z lowered."""
    low = [t.lower() for t in texts]
    return [a if len(a) == len(t) else t.translate(ASCII_LOWER) for a, t in zip(low, texts, strict=True)]


ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def keep_below(docs: DataFrame, model: Model | None, limit: float, text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose text scores under the limit. Rows are scored where they are: no join, and ids need not be unique."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        texts = [t or "" for t in batch.column(at).to_pylist()]
        keep = np.ones(len(texts), bool)
        for i, j in slices(texts, 1 << 19) if m else ():
            w = Words(fold(texts[i:j]), lower=False)
            keep[i:j] = 1 / (1 + np.exp(-np.clip(doc_features(marginals(w, m), w.first) @ m.doc, -30, 30))) < limit
        return batch.filter(pa.array(keep))

    return map_arrow(docs, run, docs.schema, PIECE)
