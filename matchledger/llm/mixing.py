"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The token weight of every cell starts as its share of what is
to be kept and is raked: each round scales the weights to the target of each margin in turn, with the bound that a cell
gives no more than its tokens (where some cells of a margin's value are at the bound, the others take over their part).
Rounds go on until the largest error of any margin is under TOLERANCE of the kept tokens, or over STALLED times what it
was two rounds before, ROUNDS at most. A cell's weight over its tokens is its sampling probability, and a document is kept if a hash of its id falls below it. Everything is
joins, aggregates and SQL functions on a table of cells.

Targets by default are tempered shares: a margin's value gets its share of tokens to a power, made to sum to 1. A value
never gets a higher target than its tokens: what it can't give, the others give in proportion. Even so, the targets of
several margins may contradict each other with the tokens at hand; the rounds then end at a compromise. report() tells
for each value of each margin its tokens, its target, what is kept in expectation, and the difference.

Defined results: a null source, language, topic or text is a value of its own (source and language '', no tokens); a
document without tokens weighs nothing and is kept with its cell's probability, or dropped where the cell has no
tokens; rows with equal ids share their fate; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchledger.llm.common import Scratch, cut

MARGINS = ("source", "lang", "topic")
#: Powers of the tempered targets.
POWERS = {"source": 0.3, "lang": 0.5, "topic": 0.7}
ROUNDS, FILLS, KEEP, SEED = 16, 4, 0.5, "mix"
#: The largest margin error, as a share of the kept tokens, at which raking ends.
TOLERANCE = 1e-3
#: An error that has not fallen below this part of that of two rounds before falls no more: the targets contradict each other.
STALLED = 0.95


def topic_of(text: Column) -> Column:
    """A coarse topic by marks of the text: licence, address (mail or web), record (labelled fields or digits), prose."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.rlike("[Ll]icen[sc]e|[Cc]opyright"), "licence").when(t.rlike("@|://"), "address").when(t.rlike("[0-9]{3}"), "record").otherwise("prose")


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r]+")), F.lit(0)).cast("long")


def unit(id_col: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 that the id decides."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0


def cell_keys(source: str = "source", lang: str = "lang", text: str = "text", topic: str | None = None) -> list[Column]:
    """The cell of a row. topic: a column; by default topic_of() the text."""
    own = topic_of(F.col(text)) if topic is None else F.coalesce(F.col(topic).cast("string"), F.lit(""))
    return [F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), own.alias("topic")]


def margin_sums(cells: DataFrame, of: str, to: str) -> DataFrame:
    """(margin, value, to): sums of a column of cells by each value of each margin."""
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("margin"), F.col(m).alias("value")) for m in MARGINS))).alias("at")
    return cells.select(each, of).groupBy("at.margin", "at.value").agg(F.sum(of).alias(to))


def targets(cells: DataFrame, keep: float = KEEP, powers: dict[str, float] | None = None, shares: DataFrame | None = None, fills: int = FILLS) -> DataFrame:
    """cells (source, lang, topic, tokens) -> (margin, value, tokens, target): the tokens to keep of each value. shares (margin, value, share) replace the tempered ones; a value without a share gets none."""
    held = margin_sums(cells, "tokens", "tokens")
    if shares is None:
        power = reduce(lambda c, m: c.when(F.col("margin") == m, (powers or POWERS)[m]), MARGINS, F)
        held = held.withColumn("part", F.pow(F.col("tokens").cast("double"), power))
    else:
        held = held.join(shares.select("margin", "value", F.col("share").cast("double").alias("part")), ["margin", "value"], "left").fillna(0.0, ["part"])
    held = held.withColumns({"full": F.lit(False), "scale": F.lit(None).cast("double")})
    open_part = F.sum(F.when(~F.col("full"), F.col("part")))
    for _ in range(fills):
        scale = held.groupBy("margin").agg(((keep * F.sum("tokens") - F.coalesce(F.sum(F.when(F.col("full"), F.col("tokens"))), F.lit(0))) / F.nullif(open_part, F.lit(0.0))).alias("scale"))
        held = held.drop("scale").join(F.broadcast(scale), "margin")  # a row for each margin
        held = held.withColumn("full", F.col("full") | F.coalesce(F.col("part") * F.col("scale") >= F.col("tokens"), F.lit(True)))
    return held.select("margin", "value", "tokens", F.when(F.col("full"), F.col("tokens").cast("double")).otherwise(F.col("part") * F.col("scale")).alias("target"))


def scaled(now: DataFrame, margin: str, target: DataFrame) -> DataFrame:
    """One step of raking: the weights scaled towards the margin's targets, within the tokens."""
    bound = F.col("weight") >= F.col("tokens")
    total, held, free = F.sum("weight").alias("total"), F.coalesce(F.sum(F.when(bound, F.col("tokens"))), F.lit(0)).alias("held"), F.coalesce(F.sum(F.when(~bound, F.col("weight"))), F.lit(0.0)).alias("free")
    sums = now.groupBy(margin).agg(total, held, free).join(target.where(F.col("margin") == margin).select(F.col("value").alias(margin), "target"), margin)
    factor = F.when(F.col("total") >= F.col("target"), F.col("target") / F.nullif("total", F.lit(0.0))).when(F.col("free") > 0, (F.col("target") - F.col("held")) / F.col("free"))
    factors = sums.select(margin, F.coalesce(factor, F.lit(1.0)).alias("factor"))
    return now.join(factors, margin).select(*MARGINS, "tokens", F.least(F.col("tokens").cast("double"), F.col("weight") * F.col("factor")).alias("weight"))


def error(now: DataFrame, target: DataFrame) -> float:
    """The largest difference of a margin's sum from its target, as a share of all that is to be kept."""
    apart = margin_sums(now, "weight", "weight").join(target, ["margin", "value"]).groupBy("margin").agg(F.max(F.abs(F.col("weight") - F.col("target"))).alias("most"), F.sum("target").alias("all"))
    return apart.agg(F.max(F.col("most") / F.nullif("all", F.lit(0.0)))).first()[0] or 0.0


def rake(cells: DataFrame, target: DataFrame, at: Scratch, keep: float = KEEP, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """cells (source, lang, topic, tokens) -> with weight, from 0 to tokens, whose sums by each margin approach the targets. A step ends in a written table, as the next one reads it twice."""
    now, errors = cells.withColumn("weight", F.col("tokens") * F.lit(keep)), []
    for _ in range(rounds):
        for margin in MARGINS:
            now = at.cut(scaled(now, margin, target), "raked")
        errors.append(error(now, target))
        if errors[-1] < tolerance or (len(errors) > 2 and errors[-1] > STALLED * errors[-3]):
            break
    return now


def calibrated(cells: DataFrame, keep: float = KEEP, powers: dict[str, float] | None = None, shares: DataFrame | None = None, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """cells (source, lang, topic, tokens) -> tables (source, lang, topic, tokens, p) and (margin, value, tokens, target)."""
    with Scratch(cells.sparkSession) as at:
        own = at.cut(cells.where("tokens > 0"), "cells")
        target = cut(targets(own, keep, powers, shares), "targets")
        raked = rake(own, target, at, keep, rounds, tolerance)
        return cut(raked.select(*MARGINS, "tokens", F.round(F.col("weight") / F.col("tokens"), 6).alias("p")), "probabilities"), target


def report(chances: DataFrame, target: DataFrame) -> DataFrame:
    """The tables of calibrated() -> (margin, value, tokens, target, expected, residual): residual is expected less target, in tokens."""
    expected = margin_sums(chances.withColumn("kept", F.col("tokens") * F.col("p")), "kept", "expected")
    return target.join(expected, ["margin", "value"]).select("margin", "value", "tokens", "target", "expected", (F.col("expected") - F.col("target")).alias("residual"))


def decide(docs: DataFrame, id_col: str = "doc_id", text: str = "text", topic: str | None = None, **options) -> DataFrame:
    """id_col, source, lang, topic, n_tokens, p, kept: one row for each row of docs."""
    facts = cut(docs.select(F.col(id_col).alias("id"), *cell_keys(text=text, topic=topic), n_tokens(F.col(text)).alias("n_tokens")), "facts")
    chances, _ = calibrated(facts.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), **options)
    p = F.coalesce("p", F.lit(0.0))
    got = facts.join(chances.drop("tokens"), list(MARGINS), "left")
    return got.select(F.col("id").alias(id_col), *MARGINS, "n_tokens", p.alias("p"), (unit(F.col("id")) < p).alias("kept"))


def sample(docs: DataFrame, id_col: str = "doc_id", text: str = "text", topic: str | None = None, **options) -> DataFrame:
    """The rows of docs that are kept, with all their columns. Rows are decided where they are: their id and cell are enough."""
    keys = cell_keys(text=text, topic=topic)
    chances, _ = calibrated(docs.select(*keys, n_tokens(F.col(text)).alias("n")).groupBy(*MARGINS).agg(F.sum("n").alias("tokens")), **options)
    own = chances.select(*(F.col(m).alias(f"__{m}") for m in MARGINS), F.col("p").alias("__p"))
    keyed = docs.select("*", *(k.alias(f"__{m}") for k, m in zip(keys, MARGINS, strict=True)))
    kept = keyed.join(own, [f"__{m}" for m in MARGINS]).where(unit(F.col(id_col)) < F.col("__p"))
    return kept.select(*docs.columns)
