"""Secret scans through a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived: every match must hold them. The
trigrams that any rule asks for are indexed: postings of document ids, one row for each trigram and block of
documents. Queries are answered by intersecting postings in Spark, and only the candidates are verified with the
rule; rules without a mandatory trigram (such as long runs of hex digits) are run over every text.

Base rules (kinds assign, access, hex) come first; the further kinds (pem, github, slack, jwt) only add spans.
A span is the whole match, in code points, end exclusive.

Defined results: a null or empty text has no spans; every row gets a result, also rows with equal ids (which share
candidates and are verified each by itself) and rows without an id (which are scanned by every rule); an empty table
gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as op
from re import _parser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchledger.llm.common import map_arrow


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    flags: int = re.ASCII
    group: int = 0  # its length counts
    least: int = 0

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in re.finditer(self.pattern, text, self.flags) if m.end(self.group) - m.start(self.group) >= self.least]


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE, 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]{32,}"),  # runs of 32 and more
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + MORE

#: Alternatives that a query may hold before it is widened.
MOST = 64


@dataclass(frozen=True)
class Known:
    """Of a part of an expression: exact is the set of strings it matches, or None; need is a set of alternatives, each a set of trigrams."""

    exact: frozenset[str] | None
    need: frozenset[frozenset[str]]


ANY = frozenset([frozenset[str]()])


def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def _loose(k: Known) -> frozenset[frozenset[str]]:
    """Its need, with what its exact strings say."""
    return frozenset(_grams(s) for s in k.exact) if k.exact is not None else k.need


def _and(a: frozenset, b: frozenset) -> frozenset:
    both = frozenset(x | y for x in a for y in b)
    return both if len(both) <= MOST else min(a, b, key=len)


def _sequence(parts: list[Known]) -> Known:
    need, run = ANY, frozenset([""])
    whole = True
    for p in parts:
        joined = frozenset(x + y for x in run for y in p.exact) if p.exact is not None else None
        if joined is not None and len(joined) <= MOST:
            run = joined
            continue
        need = _and(_and(need, frozenset(_grams(s) for s in run)), _loose(p) if p.exact is None else ANY)
        run, whole = (p.exact if p.exact is not None else frozenset([""])), False
    return Known(run, ANY) if whole else Known(None, _and(need, frozenset(_grams(s) for s in run)))


def _lower(c: str) -> str:
    """A-Z lowered, as in the texts that trigrams are looked up in."""
    return c.lower() if c.isascii() else c


#: ASCII letters that letters beyond ASCII match, too, where case is ignored.
FOLDED = frozenset("iIkKsS")


def _known(c: str, flags: int) -> bool:
    """Whether a literal can only match c, or c in the other case of A-Z."""
    if not flags & re.IGNORECASE:
        return True
    return flags & re.ASCII != 0 or (c.isascii() and c not in FOLDED)


def _node(kind, value, flags: int) -> Known:
    if kind is op.LITERAL:
        c = chr(value)
        return Known(frozenset([_lower(c)]), ANY) if _known(c, flags) else Known(None, ANY)
    if kind is op.IN and all(k is op.LITERAL and _known(chr(v), flags) for k, v in value):
        return Known(frozenset(_lower(chr(v)) for _, v in value), ANY)
    if kind is op.SUBPATTERN:
        inner = (flags | value[1]) & ~value[2]
        if value[1] & (re.ASCII | re.UNICODE):  # these two exclude each other
            inner = inner & ~(re.ASCII | re.UNICODE) | value[1] & (re.ASCII | re.UNICODE)
        return _sequence([_node(*x, inner) for x in value[3]])
    if kind is op.BRANCH:
        parts = [_sequence([_node(*x, flags) for x in branch]) for branch in value[1]]
        if all(p.exact is not None for p in parts):
            return Known(frozenset().union(*(p.exact for p in parts)), ANY)
        return Known(None, frozenset().union(*(_loose(p) for p in parts)))
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, body = value
        inner = _sequence([_node(*x, flags) for x in body])
        if (low, high) == (0, 1) and inner.exact is not None:
            return Known(inner.exact | {""}, ANY)
        return Known(None, _loose(inner) if low else ANY)
    return Known(None, ANY)


def trigram_query(pattern: str, flags: int = 0) -> list[frozenset[str]] | None:
    """Alternatives of lower-case trigrams: a text (lowered) with a match holds all of one of them. None: nothing is
    mandatory. The pattern is read with its flags, also those that it names itself, for the whole or for a group."""
    parsed = _parser.parse(pattern, flags)
    need = _loose(_sequence([_node(*x, parsed.state.flags) for x in parsed]))
    least = [x for x in need if not any(y < x for y in need)]  # what holds more than another alternative adds nothing
    return None if not all(least) else sorted(least, key=sorted)


def postings(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(trigram, ids): one row for each trigram and block of documents in which it occurs; case of A-Z is folded."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lower = [t.encode("utf-8", "surrogatepass").lower() for t in batch.column("text").to_pylist()]  # of bytes: A-Z only
        ids = batch.column("id")
        found = {g: pa.array([b in t for t in lower]) for g, b in ((g, g.encode()) for g in trigrams)}
        rows = [(g, ids.filter(m).to_pylist()) for g, m in found.items()]
        rows = [r for r in rows if r[1]]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(ids.type))], ["trigram", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    return map_arrow(rows, run, f"trigram string, ids array<{dict(rows.dtypes)['id']}>")


def candidates(index: DataFrame, queries: dict[int, list[frozenset[str]]]) -> DataFrame:
    """(id, rules array<int>): the documents whose postings satisfy a rule's query."""
    grams = sorted(set().union(*(g for alts in queries.values() for g in alts)))
    bit = {g: 1 << i for i, g in enumerate(grams)}  # at most 63 trigrams in one word; more take further words
    words = range(0, len(grams), 63)
    col = F.col("trigram")
    each = index.select(F.explode("ids").alias("id"), "trigram")
    sums = [F.bit_or(F.coalesce(F.element_at(F.create_map(*(F.lit(v) for g in grams[w : w + 63] for v in (g, bit[g] >> w))), col), F.lit(0)).cast("long")).alias(f"w{w}") for w in words]
    held = each.groupBy("id").agg(*sums)

    def has(alt: frozenset[str]):
        masks = [sum(bit[g] >> w for g in alt if g in grams[w : w + 63]) for w in words]
        return F.expr(" and ".join(f"(w{w} & {m}L) = {m}L" for w, m in zip(words, masks, strict=True)))

    def any_of(alts):
        cond = F.lit(False)
        for a in alts:
            cond = cond | has(a)
        return cond

    rules = F.array_compact(F.array(*(F.when(any_of(alts), F.lit(k)) for k, alts in queries.items())))
    return held.select("id", rules.alias("rules")).where("size(rules) > 0")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id_col, spans array<struct<kind,start,end>> by start and then by the order of the rules: one row for each row of docs."""
    queries = {k: q for k, r in enumerate(rules) if (q := trigram_query(r.pattern, r.flags))}
    always = [k for k in range(len(rules)) if k not in queries]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    grams = sorted(set().union(*(g for alts in queries.values() for g in alts)))
    if grams:
        rows = rows.join(candidates(postings(docs, grams, id_col, text), queries), "id", "left")
    else:
        rows = rows.withColumn("rules", F.lit(None).cast("array<int>"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for i, t, chosen in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "rules")), strict=True):
            use = always + (chosen or []) if i is not None else range(len(rules))
            got = [(s, k, e) for k in use for s, e in rules[k].spans(t or "")]
            out.append([{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in sorted(got)])
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, span)], ["id", "spans"])

    got = map_arrow(rows.select("id", "text", "rules"), run, f"id {dict(rows.dtypes)['id']}, spans array<struct<kind:string,start:int,end:int>>")
    return got.withColumnRenamed("id", id_col)


def joined(spans, kinds: tuple[str, ...] | None = None):
    """kind:start:end of the spans, comma-joined."""
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else spans
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


