"""Matches against independent witnesses: standings, brackets and highlighted cells.

Standings come as rows (page, scope, club, pj, gf, gc, g, e, p): matches played, goals for and against, won, drawn, lost.
scope is the stage that a table speaks of, '' for the whole page. Waivers are rows (page, club) that a person has reviewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchledger.functions.text import base_name, pair_key
from matchledger.operators.checks import sample, sides
from matchledger.operators.relational import top1
from matchledger.schema import GROUPS, KNOCKOUT

FIGURES = ("pj", "gf", "gc", "g", "e", "p")


def totals(m: DataFrame, *more: str) -> DataFrame:
    """page, more, club and figures of the group stage's scored matches."""
    played = sides(m.where((F.col("phase") == GROUPS) & F.col("hs").isNotNull() & F.col("aws").isNotNull()), *more)
    return played.groupBy("page", *more, "club").agg(
        F.count("*").alias("pj"), F.sum("gf").alias("gf"), F.sum("gc").alias("gc"),
        F.count_if(F.col("gf") > F.col("gc")).alias("g"), F.count_if(F.col("gf") == F.col("gc")).alias("e"), F.count_if(F.col("gf") < F.col("gc")).alias("p"),
    )


def scoped_totals(m: DataFrame) -> DataFrame:
    """totals() for the whole page (scope '') and for each of its stages. Both come from one aggregation by stage."""
    each = totals(m, "section")
    whole = each.groupBy("page", "club").agg(*(F.sum(c).alias(c) for c in FIGURES))
    cols = ["page", "scope", "club", *FIGURES]
    return whole.withColumn("scope", F.lit("")).select(*cols).union(each.where("section <> ''").withColumnRenamed("section", "scope").select(*cols))


def table_scopes(tables: DataFrame, headings: DataFrame, m: DataFrame) -> DataFrame:
    """tables (page, pos) -> with scope: the level-2 heading before a table if it names a group stage, else ''. headings: (page, pos, level, title)."""
    marks = headings.where("level = 2").select("page", "pos", F.col("title").alias("mark"), F.lit(0).alias("kind")).union(tables.select("page", "pos", F.lit(None).cast("string").alias("mark"), F.lit(1).alias("kind")).distinct())
    held = marks.withColumn("mark", F.last("mark", ignorenulls=True).over(Window.partitionBy("page").orderBy("pos", "kind"))).where("kind = 1").select("page", "pos", "mark")
    stages = m.where((F.col("phase") == GROUPS) & (F.col("section") != "")).select("page", F.col("section").alias("mark")).distinct()
    known = held.join(stages.withColumn("is_stage", F.lit(True)), ["page", "mark"], "left").select("page", "pos", F.when(F.col("is_stage"), F.col("mark")).otherwise("").alias("scope"))
    return tables.join(known, ["page", "pos"])


def merged(rows: DataFrame) -> DataFrame:
    """Standings rows with seq -> one for each page, scope and club: the one with most matches, the first of equals."""
    return top1(rows, ["page", "scope", "club"], F.desc("pj"), "seq").select("page", "scope", "club", *FIGURES)


def closes(gf: Column, gc: Column, diff: Column, g: Column, e: Column, p: Column, pj: Column) -> Column:
    """Why a standings row contradicts itself; '' if it does not."""
    goals = F.when(gf - gc != diff, F.concat(F.lit("difference "), diff, F.lit(" is not "), gf - gc))
    games = F.when(g + e + p != pj, F.concat(F.lit("played "), pj, F.lit(" is not "), g + e + p))
    return F.concat_ws("; ", goals, games)


def compared(published: DataFrame, m: DataFrame) -> DataFrame:
    """Published figures with ours beside them (o_pj .. o_p), by page, scope and club; rows of clubs that played only."""
    ours = scoped_totals(m)
    return published.join(ours.select("page", "scope", "club", *(F.col(c).alias(f"o_{c}") for c in FIGURES)), ["page", "scope", "club"])


def _widest(both: DataFrame) -> DataFrame:
    """One comparison for each page and club: that of the table with most matches."""
    return top1(both, ["page", "club"], F.desc("pj"), "scope")


def not_waived(df: DataFrame, waivers: DataFrame | None) -> DataFrame:
    return df if waivers is None else df.join(waivers.select("page", "club").distinct(), ["page", "club"], "left_anti")


def goals_differ(published: DataFrame, m: DataFrame, waivers: DataFrame | None = None) -> DataFrame:
    """Clubs whose goals differ over equally many matches; n_deviating is the page's count of them, waived ones too (with one alone, the table's row is suspect)."""
    off = _widest(compared(published, m)).where("pj = o_pj and (gf <> o_gf or gc <> o_gc)")
    return not_waived(off.withColumn("n_deviating", F.count("*").over(Window.partitionBy("page"))), waivers).select("page", "club", "pj", "gf", "gc", "o_gf", "o_gc", "n_deviating")


def results_differ(published: DataFrame, m: DataFrame, waivers: DataFrame | None = None) -> DataFrame:
    """Clubs with the same matches but other results; `blame` is the table's row where even the goals agree, else a match."""
    off = _widest(compared(published, m)).where("pj = o_pj and not (g = o_g and e = o_e and p = o_p)")
    blame = F.when((F.col("gf") == F.col("o_gf")) & (F.col("gc") == F.col("o_gc")), "table").otherwise("match")
    return not_waived(off, waivers).select("page", "club", "pj", "g", "e", "p", "o_g", "o_e", "o_p", blame.alias("blame"))


def games_differ(published: DataFrame, m: DataFrame, waivers: DataFrame | None = None) -> DataFrame:
    """Clubs with other numbers of matches. Nothing is said where over half of a scope's clubs deviate; two clubs that are off by the same are named as a pair."""
    scope = Window.partitionBy("page", "scope")
    off = (F.col("pj") != F.col("o_pj")).cast("int")
    both = compared(published, m).withColumn("clubs", F.count("*").over(scope)).withColumn("off", F.sum(off).over(scope))
    kept = not_waived(both.where("pj <> o_pj and off * 2 <= clubs"), waivers).withColumn("delta", F.col("o_pj") - F.col("pj"))
    return kept.withColumn("is_pair", F.count("*").over(Window.partitionBy("page", "scope", "delta")) == 2).select("page", "scope", "club", "pj", "o_pj", "delta", "clubs", "is_pair")


def unbalanced(published: DataFrame, m: DataFrame) -> DataFrame:
    """Scopes whose table covers exactly our clubs and matches, but whose goals for and against do not add up to the same."""
    ours = scoped_totals(m).select("page", "scope", "club", F.col("pj").alias("o_pj"))
    asked = published.select("page", "scope").distinct()
    full = published.join(ours.join(asked, ["page", "scope"], "left_semi"), ["page", "scope", "club"], "full_outer")
    held = full.groupBy("page", "scope").agg(F.bool_and(F.coalesce(F.col("pj") == F.col("o_pj"), F.lit(False))).alias("same"), F.sum("gf").alias("gf"), F.sum("gc").alias("gc"))
    return held.where("same and gf <> gc").select("page", "scope", "gf", "gc")


def deviating(published: DataFrame, m: DataFrame) -> DataFrame:
    """page, club: those who deviate in any figure that is compared, waivers or not."""
    odd = "pj <> o_pj or gf <> o_gf or gc <> o_gc or g <> o_g or e <> o_e or p <> o_p"
    return compared(published, m).where(odd).select("page", "club").distinct()


def stale_waivers(waivers: DataFrame, published: DataFrame, m: DataFrame) -> DataFrame:
    """Waivers that no raw deviation needs any more."""
    return waivers.join(deviating(published, m), ["page", "club"], "left_anti")


def without_matches(published: DataFrame, m: DataFrame) -> DataFrame:
    """Clubs of a table that play no match in its scope."""
    play = sides(m, "section").select("page", F.explode(F.array_distinct(F.array(F.lit(""), "section"))).alias("scope"), "club").distinct()
    lone = published.select("page", "scope", "club").join(play, ["page", "scope", "club"], "left_anti")
    return lone.groupBy("page", "club").agg(F.min("scope").alias("scope"))


def unanswered_highlights(accused: DataFrame, published: DataFrame, m: DataFrame) -> DataFrame:
    """accused (page, row_id, home, away, ...): matches whose highlighted cell contradicts the score, without those of which both clubs' results agree with the table."""
    agreed = compared(published, m).where("g = o_g and e = o_e and p = o_p").select("page", F.col("club")).distinct()
    backed = accused.select("page", "row_id", F.explode(F.array_distinct(F.array("home", "away"))).alias("club")).join(agreed, ["page", "club"], "left_anti")
    return accused.join(backed.select("page", "row_id").distinct(), ["page", "row_id"], "left_semi")


def namesakes(names: DataFrame) -> DataFrame:
    """names (entity, name: every alias and the entity's own) -> (entity, other): entities that share a base name."""
    based = names.select("entity", base_name(F.col("name")).alias("base")).distinct()
    return based.join(based.withColumnRenamed("entity", "other"), "base").where("entity <> other").select("entity", "other").distinct()


def bare_namesakes(m: DataFrame, published: DataFrame, linked: DataFrame, names: DataFrame) -> DataFrame:
    """Clubs of the matches without a parenthesis that the page never links, with a namesake that it both links and tabulates. linked: (page, club)."""
    own = sides(m).select("page", "club").distinct().where(~F.col("club").contains("(")).join(linked, ["page", "club"], "left_anti")
    sure = linked.join(published.select("page", "club").distinct(), ["page", "club"], "left_semi").select("page", F.col("club").alias("other"))
    pairs = own.join(namesakes(names), F.col("club") == F.col("entity")).join(sure, ["page", "other"])
    return pairs.select("page", "club", "other").distinct()


def bracket_clubs(bracket: DataFrame, m: DataFrame, names: DataFrame) -> DataFrame:
    """bracket (page, club; club null where the registry knows none, then written) -> (page, kind, club, detail): unknown clubs, clubs of which only a namesake plays, and those who play nowhere."""
    unknown = bracket.where("club is null").select("page", F.lit("unknown").alias("kind"), F.col("written").alias("club"), F.lit("").alias("detail"))
    play = sides(m).select("page", "club").distinct()
    out = bracket.where("club is not null").select("page", "club").distinct().join(play, ["page", "club"], "left_anti")
    near = out.join(namesakes(names), F.col("club") == F.col("entity")).join(play.withColumnRenamed("club", "other"), ["page", "other"]).select("page", "club", "other")
    with_namesake = near.groupBy("page", "club").agg(F.array_join(F.array_sort(F.collect_set("other")), ", ").alias("detail"))
    rest = sample(out.join(near, ["page", "club"], "left_anti"), ["page"], ["club"], 6, F.col("club"))
    return unknown.union(with_namesake.select("page", F.lit("namesake"), "club", "detail")).union(rest.select("page", F.lit("absent"), F.col("total").cast("string"), "shown"))


def bracket_scores(legs: DataFrame, m: DataFrame, waived_pairs: DataFrame | None = None) -> DataFrame:
    """legs (page, one, two, a, b): scores that a bracket tells for a pair, which the matches do not have in either order. kind: other_score (the pair has knockout matches), only_groups, or never."""
    scored = lambda x, y, a, b: F.when(x <= y, F.concat_ws("\t", x, y, a, b)).otherwise(F.concat_ws("\t", y, x, b, a))
    told = legs.withColumn("pair", pair_key(F.col("one"), F.col("two"))).withColumn("leg", scored(F.col("one"), F.col("two"), F.col("a"), F.col("b")))
    ours = m.withColumn("pair", pair_key(F.col("home"), F.col("away")))
    have = ours.select("page", scored(F.col("home"), F.col("away"), F.col("hs"), F.col("aws")).alias("leg")).distinct()
    lack = told.join(have, ["page", "leg"], "left_anti")
    if waived_pairs is not None:
        lack = lack.join(waived_pairs.select("page", pair_key(F.col("one"), F.col("two")).alias("pair")).distinct(), ["page", "pair"], "left_anti")
    met = ours.groupBy("page", "pair").agg(F.bool_or(F.col("phase") == KNOCKOUT).alias("in_knockout"))
    kind = F.when(F.col("in_knockout"), "other_score").when(F.col("in_knockout").isNotNull(), "only_groups").otherwise("never")
    return lack.join(met, ["page", "pair"], "left").select("page", "one", "two", "a", "b", kind.alias("kind"))


def false_matchdays(m: DataFrame) -> DataFrame:
    """m with the label of a matchday removed where it can be none: more matches than clubs, and a club plays more than once. `blanked` says where."""
    keys = ["page", "section", "grp", "matchday"]
    labelled = m.where((F.col("phase") == GROUPS) & (F.col("matchday") != ""))
    clubs = sides(labelled, *keys[1:]).groupBy(*keys, "club").agg(F.count("*").alias("n"))
    held = clubs.groupBy(*keys).agg((F.sum("n") / 2).alias("matches"), F.count("*").alias("clubs"), F.max("n").alias("most"))
    false = held.where("matches > clubs and most > 1").select(*keys, F.lit(True).alias("false"), F.lit(GROUPS).alias("phase"))
    marked = m.join(false, [*keys, "phase"], "left")
    return marked.withColumn("blanked", F.coalesce("false", F.lit(False))).withColumn("matchday", F.when(F.col("false"), "").otherwise(F.col("matchday"))).select(*m.columns, "blanked")


def fewer_rows(new: DataFrame, old: DataFrame, excused: DataFrame | None = None) -> DataFrame:
    """Tournaments and seasons with fewer rows than before. excused: (tournament, season)."""
    key = ["tournament", "season"]
    count = lambda df, name: df.select("tournament", F.col("season").cast("int").alias("season")).groupBy(*key).agg(F.count("*").alias(name))
    both = count(old, "had").join(count(new, "has"), key, "left").withColumn("has", F.coalesce("has", F.lit(0)))
    lost = both.where("has < had").withColumn("vanished", F.col("has") == 0)
    return lost if excused is None else lost.join(excused.select(*key).distinct(), key, "left_anti")


def dated_migrations(dated: DataFrame, undated: DataFrame, old_dated: DataFrame, old_undated: DataFrame) -> DataFrame:
    """(tournament, season) whose undated rows became fewer while dated ones became more; none at all if a dated row has no date."""
    key = ["tournament", "season"]
    count = lambda df, name: df.select("tournament", F.col("season").cast("int").alias("season")).groupBy(*key).agg(F.count("*").alias(name))
    all_dated = dated.agg(F.coalesce(F.bool_and(F.trim(F.coalesce("date", F.lit(""))) != ""), F.lit(True)).alias("ok"))
    both = count(old_undated, "u0").join(count(undated, "u1"), key, "left").join(count(old_dated, "d0"), key, "left").join(count(dated, "d1"), key, "left")
    moved = both.where("coalesce(u1, 0) < u0 and coalesce(d1, 0) > coalesce(d0, 0)").select(*key, F.lit(True).alias("ok"))
    return moved.join(F.broadcast(all_dated), "ok").select(*key)  # all_dated has one row


def incompatible_levels(m: DataFrame, levels: DataFrame) -> DataFrame:
    """Clubs that play, in one season, competitions two levels or more apart. levels: (competition, level)."""
    # each club's competitions once: their rows are few, whatever the number of matches
    ranked = sides(m, "competition", "season").select("club", "season", "competition").distinct().join(levels, "competition")
    held = ranked.groupBy("club", "season").agg(F.max("level").alias("high"), F.min("level").alias("low"), F.array_join(F.array_sort(F.collect_set("competition")), ", ").alias("competitions"))
    return held.where("high - low >= 2").select("club", "season", (F.col("high") - F.col("low")).alias("apart"), "competitions")
