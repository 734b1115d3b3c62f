"""URL filters by pattern rules that are indexed by their rarest literal token.

A rule has a regular expression over host and path, and literal tokens (runs of letters and digits, in lower case)
that every URL it matches holds whole; a token may be one of several, as in `ad|ads`. Each rule is indexed under the one
of its tokens that fewest URLs hold, which is counted over all URLs. The tokens of a URL fetch its candidate rules, and
only their regular expressions are run; rules without a token (ALWAYS at most) are run on every URL. Everything is joins
and SQL functions. Rules come as Rule objects or as a DataFrame (name, pattern, tokens array<string>, verdict, rank).

Defined results: a null URL and one without `://` have empty host and path and are judged as such; ties between rules
go to the name that sorts last; every row gets a result, repeated or not; an empty table gives an empty result. Only
the key and URL columns are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Rules of which an index is broadcast; more, and rules in a DataFrame, are joined as Spark chooses by their size.
BROADCAST_RULES = 100_000
#: Rules without a token that a filter may have: each of them reads every URL.
ALWAYS = 1000


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    rank: int = 1  # the highest rank wins, then the longest name


def host_rule(name: str, verdict: str) -> Rule:
    """`host/path`: fits the host and its subdomains where the path starts with the rule's."""
    host, slash, path = name.partition("/")
    whole = re.findall("[a-z0-9]+", host.lower()) + re.findall("[a-z0-9]+", re.sub("[A-Za-z0-9]+$", "", path).lower())  # a last segment may go on
    return Rule(name, rf"^([^/]*\.)?{re.escape(host)}{re.escape(slash + path)}", tuple(dict.fromkeys(whole)), verdict)


BASE = (host_rule("net/", "block"), host_rule("example.net/en/", "allow"), host_rule("example.com/de/", "block"), host_rule("org/fr/", "allow"))
#: What the filter adds where no base rule fits.
MORE = (
    Rule("ads", r"(^|[./_-])ads?[./_-]", ("ad|ads",), "block", 0),
    Rule("login", r"/(wp-)?login(\.php)?(/|$)", ("login",), "block", 0),
    Rule("casino", r"(^|[./_-])casino[./_-]", ("casino",), "block", 0),
    Rule("doubleclick", r"(^|\.)doubleclick\.", ("doubleclick",), "block", 0),
    Rule("exe", r"\.exe$", ("exe",), "block", 0),
)
RULES = BASE + MORE


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, SPLIT, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, SPLIT, 2), F.lit(""))


def tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), 1))


Rules = tuple[Rule, ...] | DataFrame


def rule_table(spark: SparkSession, rules: Rules) -> DataFrame:
    """(name, pattern, verdict, rank, tokens)"""
    if isinstance(rules, DataFrame):
        return rules.select("name", "pattern", "verdict", F.col("rank").cast("int").alias("rank"), F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"))
    return spark.createDataFrame([(r.name, r.pattern, r.verdict, r.rank, list(r.tokens)) for r in rules], "name string, pattern string, verdict string, rank int, tokens array<string>")


def rarest(urls: DataFrame, rules: Rules) -> DataFrame:
    """(name, pattern, verdict, rank, token): each rule under its rarest token, once for each that it may be; null where it has none. urls: (place, ...)."""
    own = rule_table(urls.sparkSession, rules)
    each = own.select("name", F.explode("tokens").alias("one_of")).select("name", "one_of", F.explode(F.split("one_of", r"\|")).alias("token"))
    asked = each.select("token").distinct()
    if not isinstance(rules, DataFrame) and len(rules) <= BROADCAST_RULES:
        asked = F.broadcast(asked)
    counts = urls.select(F.explode(tokens(F.col("place"))).alias("token")).join(asked, "token").groupBy("token").agg(F.count("*").alias("n"))
    held = each.join(counts, "token", "left").groupBy("name", "one_of").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    best = held.groupBy("name").agg(F.min_by("one_of", F.struct("n", "one_of")).alias("one_of"))
    return own.drop("tokens").join(best, "name", "left").select("name", "pattern", "verdict", "rank", F.explode_outer(F.split("one_of", r"\|")).alias("token"))


def judge(pages: DataFrame, rules: Rules = RULES, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """key, host, path, rule (of rank 1 and more; else null), verdict."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"))
    placed = rows.select("key", host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).withColumn("place", F.concat("host", "path"))
    index = rarest(placed, rules).where("token is not null")
    if not isinstance(rules, DataFrame) and len(rules) <= BROADCAST_RULES:
        index = F.broadcast(index)
    fetched = placed.select("place", F.explode(tokens(F.col("place"))).alias("token")).join(index, "token")
    everywhere = rule_table(pages.sparkSession, rules).where("size(tokens) = 0").limit(ALWAYS + 1).collect() if isinstance(rules, DataFrame) else [r for r in rules if not r.tokens]
    if len(everywhere) > ALWAYS:
        raise ValueError(f"over {ALWAYS} rules have no token")
    hits = fetched.where("place rlike pattern").select("place", "rank", "name", "verdict")
    if everywhere:
        always = F.filter(F.array(*(F.when(F.col("place").rlike(r.pattern), F.struct(F.lit(r.rank).alias("rank"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))) for r in everywhere)), lambda x: x.isNotNull())
        hits = hits.union(placed.select("place", F.inline(always)))
    best = hits.groupBy("place").agg(F.max(F.struct("rank", F.length("name").alias("size"), "name", "verdict")).alias("best"))
    return placed.join(best, "place", "left").select(
        F.col("key").alias(key), "host", "path", F.when(F.col("best.rank") > 0, F.col("best.name")).alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
