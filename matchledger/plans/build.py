"""The whole build: from pages to published matches, behind a gate that writes nothing while a severe finding stands.

Stages end in tables of the shared folder, so that every plan is small: what pages say (kept by content in a store of
extracts), named and amended matches, dated matches, and findings, which each check appends to one table by itself. The
driver only decides whether to write. The order of the stages matters: names before amendments, false matchdays before
dates are filled, dates before checks.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.functions.text import normalized, source_page
from matchledger.operators import amend, checks, entities, joins, reconcile
from matchledger.operators.checks import text
from matchledger.schema import FINDING, GROUPS, MATCH
from matchledger.sinks import published as sink
from matchledger.sinks.shared import cut, folder  # noqa: F401
from matchledger.sources import extracts, feeds, published

AMENDMENTS = {
    "swap": (["page", "matchday", "home", "away", "hs", "aws"], ["home", "away"]),
    "venue": (["page", "matchday", "home", "away", "venue"], ["venue"]),
    "replace": (["page", "section", "matchday", "home", "away", "hs", "aws"], ["home", "away", "hs", "aws"]),
}


MATCH_COLUMNS = [c.split()[0] for c in MATCH.split(", ")]


@dataclass(frozen=True)
class Inputs:
    """pages (page, text); catalog (page, url, tournament, season, last_year, from_month, layout, neutral, closed, and gridless if there are such pages); registry (entity, ext_id, aliases); the rest may be left out.

    amendments by kind: swap, score, split, missing, alias, venue, replace. sources: external matches by credit, in the
    order in which they fill dates; their clubs are home_club and away_club, or to be named if mapped by votes.
    Pages that the catalogue flags `gridless` have no results of their own: theirs are read from reports (page, text) by
    the names in report_names (page, grp, short, club), and from nowhere else."""

    pages: DataFrame
    catalog: DataFrame
    registry: DataFrame
    articles: DataFrame | None = None
    amendments: dict[str, DataFrame] = field(default_factory=dict)
    sources: dict[str, DataFrame] = field(default_factory=dict)
    voted: frozenset[str] = frozenset()
    waivers: DataFrame | None = None
    ties: DataFrame | None = None
    arbitrated: DataFrame | None = None
    reports: DataFrame | None = None
    report_names: DataFrame | None = None


@dataclass(frozen=True)
class Built:
    matches: DataFrame
    findings: DataFrame


def findings(df: DataFrame, check: str, severe: bool, *subject) -> DataFrame:
    return df.select("page", F.lit(check).alias("check"), F.lit(severe).alias("severe"), F.concat_ws(" ", *subject).alias("subject"), F.lit("").alias("detail"))


def indexes(given: Inputs) -> tuple[DataFrame, DataFrame | None]:
    """(names, articles) of the registry, written once."""
    names = cut(entities.name_index(given.registry), "names")
    return names, cut(entities.article_index(given.articles, given.registry), "articles") if given.articles is not None else None


def imported(given: Inputs) -> tuple[DataFrame, DataFrame]:
    """(matches, findings) of pages without a grid, from their reports. A page whose report is missing or tells no match
    is left without any, which is severe; what the reports say that cannot be used is told."""
    spark = given.pages.sparkSession
    pages = given.catalog.where("gridless").select("page", F.col("season").alias("first_year"), "last_year", "from_month")
    if given.reports is None or given.report_names is None:
        return spark.createDataFrame([], MATCH), findings(pages, "import_failed", True, F.lit("no reports"))
    rows, problems = feeds.report_matches(given.reports.join(pages.select("page"), "page", "left_semi"), given.report_names, pages, cut)
    rows = cut(rows, "imported")
    blank, none = F.lit(""), F.lit(None)
    cols = {
        "row_id": F.concat_ws("#", "page", F.lit("2"), "section", "grp", F.col("matchday").cast("string"), "home", "away"), "time": blank, "hpens": none.cast("int"), "apens": none.cast("int"), "competition": F.col("tournament"),
        "phase": F.lit(GROUPS), "matchday": F.concat(F.lit("Fecha "), F.col("matchday").cast("string")), "venue": blank, "neutral": none.cast("boolean"), "date_credit": blank,
    }
    m = rows.join(given.catalog.select("page", "tournament", "season"), "page")
    lost = pages.select("page").join(rows.select("page").distinct(), "page", "left_anti")
    told = problems.select("page", F.concat(F.lit("import_"), "kind").alias("check"), F.lit(False).alias("severe"), F.col("detail").alias("subject"), blank.alias("detail"))
    return m.select(*(cols.get(k, F.col(k)).alias(k) for k in MATCH_COLUMNS)), told.union(findings(lost, "import_failed", True, F.lit("the report")))


def extract(given: Inputs, told: dict[str, DataFrame], names: DataFrame, articles: DataFrame | None) -> DataFrame:
    """Matches of the pages with their clubs' own names. told: the tables of sources.extracts."""
    by_page = cut(entities.page_articles(told["links"]), "links")
    m = told["matches"].drop("row").join(given.catalog.where("not gridless").select("page", F.col("tournament").alias("competition"), "season"), "page").withColumn("date_credit", F.lit(""))
    for side in ("home", "away"):
        linked = m.join(by_page.select("page", F.col("visible").alias(side), F.col("article").alias("__art")), ["page", side], "left").withColumn("__art", F.coalesce("__art", F.lit("")))
        m = entities.canonized(linked, side, "__art", names, articles).drop("__art")
    m = m.select(*MATCH_COLUMNS)
    if given.ties is not None:
        judged = joins.without_repeats(given.ties, m)
        m = m.unionByName(judged.where("verdict = 'new'").select(*given.ties.columns), allowMissingColumns=True)
    return m


def amended(m: DataFrame, amendments: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """All amendments in their order; (matches, problems)."""
    problems = [m.sparkSession.createDataFrame([], amend.PROBLEM)]

    def take(result: amend.Result) -> DataFrame:
        problems.append(result[1])
        return result[0]

    if "swap" in amendments:
        m = take(amend.update(m, amendments["swap"], *AMENDMENTS["swap"], "swap"))
    if "score" in amendments:
        m = take(amend.rescore(m, amendments["score"], ["page", "matchday", "home", "away", "hs", "aws"]))
    if "split" in amendments:
        m = take(amend.delete(m, amendments["split"], ["page", "home", "away", "hs", "aws"]))
    if "missing" in amendments:
        blank = {"hpens": F.lit(None).cast("int"), "apens": F.lit(None).cast("int"), "status": F.lit("")}
        m = take(amend.insert(m, amendments["missing"], ["page", "matchday", "home", "away"], ["home", "away", "hs", "aws", "date"], ["page", "matchday"], blank))
    if "alias" in amendments:
        m = take(amend.rename(m, amendments["alias"]))
    for kind in ("venue", "replace"):
        if kind in amendments:
            m = take(amend.update(m, amendments[kind], *AMENDMENTS[kind], kind))
    return m, reduce(DataFrame.union, problems)


def fill_dates(m: DataFrame, given: Inputs, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each source in turn; (matches, findings). Dates that fall outside of a page's season are cleared, which is severe."""
    told = [m.sparkSession.createDataFrame([], FINDING)]
    for credit, ext in given.sources.items():
        if credit in given.voted:
            mapping = joins.vote_mapping(m, ext)
            told.append(findings(mapping.where("clash").select("page").distinct(), "id_map_unusable", False, F.lit(credit)))
            ext = joins.named(ext, joins.usable(mapping), names)
        got = cut(joins.verified_fill(m, ext, credit, given.arbitrated), "filled")
        held = got.groupBy("page", "fill").agg(F.count("*").alias("n")).where("fill is not null")
        told.append(held.select("page", F.concat(F.lit("dates_"), "fill").alias("check"), F.lit(False).alias("severe"), F.lit(credit).alias("subject"), text(F.col("n")).alias("detail")))
        m = got.drop("fill")
    seasons = given.catalog.select("page", F.col("season").alias("first_year"), "last_year")
    kept = joins.in_season(m, seasons)
    told.append(findings(kept.where("cleared"), "date_out_of_season", True, F.col("row_id")))
    return kept.drop("cleared"), reduce(DataFrame.union, told)


def cross_checked(m: DataFrame, given: Inputs, pages: dict[str, DataFrame], names: DataFrame, articles: DataFrame | None) -> dict[str, DataFrame]:
    """Findings of the page's other witnesses by check: standings, brackets, notes and highlights; none is severe. pages: the tables of sources.extracts."""
    told = cut(entities.resolve(pages["standings"], "club", "article", names, articles, "entity"), "standings")
    rows = reconcile.table_scopes(told.withColumn("club", F.coalesce("entity", "club")).where("closes"), pages["headings"], m)
    table = cut(reconcile.merged(rows), "tables")
    club = F.col("club")
    bracket = entities.resolve(pages["slots"], "name", "article", names, articles, "club").select("page", F.col("name").alias("written"), "club").distinct()
    legs = pages["legs"]
    for side in ("one", "two"):
        legs = entities.resolve(legs, side, f"{side}_article", names, articles, f"{side}_club")
    legs = legs.where("one_club is not null and two_club is not null").select("page", F.col("one_club").alias("one"), F.col("two_club").alias("two"), "a", "b")
    own_names = entities.alias_rows(given.registry)
    accused = pages["highlights"].withColumn("row_id", F.concat_ws(" ", "home", "hs", "aws", "away"))
    parts = {
        "standings_goals": findings(reconcile.goals_differ(table, m, given.waivers), "standings_goals", False, club),
        "standings_results": findings(reconcile.results_differ(table, m, given.waivers), "standings_results", False, club, F.col("blame")),
        "standings_games": findings(reconcile.games_differ(table, m, given.waivers), "standings_games", False, club, F.col("delta")),
        "standings_unbalanced": findings(reconcile.unbalanced(table, m), "standings_unbalanced", False, F.col("scope")),
        "standings_without_matches": findings(reconcile.without_matches(table, m), "standings_without_matches", False, club),
        "standings_row_open": findings(told.where("not closes"), "standings_row_open", False, club),
        "standings_unknown": findings(entities.outside(told, "club", "entity"), "standings_unknown", False, club),
        "bracket_clubs": findings(reconcile.bracket_clubs(bracket, m, own_names), "bracket_clubs", False, F.col("kind"), club),
        "bracket_scores": findings(reconcile.bracket_scores(legs, m), "bracket_scores", False, F.col("kind"), F.col("one"), F.col("two")),
        "void_match": findings(pages["voided"], "void_match", False, F.col("home"), F.col("away")),
        "unread_ruling": findings(pages["rulings"], "unread_ruling", False, F.col("home"), F.col("away")),
        "highlight": findings(reconcile.unanswered_highlights(accused, table, m), "highlight", False, F.col("row_id")),
    }
    if articles is not None:
        parts["contradictory_link"] = findings(entities.contradictory_links(pages["links"], names, articles), "contradictory_link", False, F.col("visible"), F.col("article"))
    if given.waivers is not None:
        parts["stale_waiver"] = findings(reconcile.stale_waivers(given.waivers, table, m), "stale_waiver", False, club)
    if "alias" in given.amendments:
        written = checks.sides(m).select("page", F.col("club").alias("name"))
        parts["unused_alias"] = findings(entities.unused_aliases(given.amendments["alias"].select("page", "name"), written), "unused_alias", False, F.col("name"))
    return parts


#: Checks that run at a time. Each is a small plan; what one waits for, another uses.
CHECKS_AT_ONCE = 4


def appended(spark: SparkSession, parts: dict[str, DataFrame]) -> DataFrame:
    """The findings of all checks as one table by check, to which each check adds its own rows. A check that fails stops the build."""
    at = folder(spark, "findings")
    with ThreadPoolExecutor(CHECKS_AT_ONCE) as pool:
        list(pool.map(lambda kv: kv[1].write.parquet(f"{at}/part={kv[0]}"), parts.items()))
    return spark.read.schema(f"{FINDING}, part string").parquet(at).drop("part")


def process(given: Inputs, store: str | None = None) -> Built:
    """store: the folder of extracts of earlier builds; without one, all pages are read."""
    spark = given.pages.sparkSession
    if "gridless" not in given.catalog.columns:
        given = replace(given, catalog=given.catalog.withColumn("gridless", F.lit(False)))
    names, articles = indexes(given)
    store = store or folder(spark, "extracts")
    about = given.catalog.select("page", F.col("season").alias("first_year"), "last_year", "from_month", "layout")
    pages = extracts.read(store, cut(extracts.refresh(store, given.pages, about), "present"))
    others, import_told = imported(given) if not given.catalog.where("gridless").isEmpty() else (None, None)
    m = extract(given, pages, names, articles)
    if others is not None:
        m = m.unionByName(entities.canonized(entities.canonized(others, "home", None, names), "away", None, names))
    m, problems = amended(cut(m, "named"), given.amendments)
    blanked = cut(reconcile.false_matchdays(m), "amended")
    m, dates_told = fill_dates(blanked.drop("blanked"), given, names)
    m = cut(m, "matches")
    known = given.registry.select(F.col("entity").alias("name"))
    unmatched = problems.select(F.lit("").alias("page"), F.concat(F.lit("amendment_"), "step").alias("check"), F.lit(True).alias("severe"), F.col("amendment").alias("subject"), text(F.col("matched")).alias("detail"))
    parts = {name: check(m) for name, check in checks.CHECKS.items()} | {"unknown_names": checks.unknown_names(m, known)}
    parts |= cross_checked(m, given, pages, names, articles)
    if import_told is not None:
        parts["imports"] = import_told
    parts |= {"dates": dates_told, "amendments": unmatched, "blanked": findings(blanked.where("blanked").select("page", "row_id"), "matchday_blanked", False, F.col("row_id"))}
    return Built(m, appended(spark, parts))


@dataclass(frozen=True)
class Outcome:
    code: int
    written: dict[str, dict[str, int]]
    lost: DataFrame | None
    findings: DataFrame


def reusable(old: DataFrame, catalog: DataFrame) -> DataFrame:
    """Published rows of closed pages, by the URL in their source."""
    closed = catalog.where("closed").select(F.col("url").alias("__url"))
    return old.withColumn("__url", source_page(F.col("source"))).join(closed, "__url", "left_semi").drop("__url")


def release(spark: SparkSession, rows: DataFrame, findings_: DataFrame, out: str, dry: bool = False, force: bool = False) -> Outcome:
    """Publishes rows (as published) under out, dated and undated at once, unless the gate or the guard against
    shrinking holds. code 0: published (or a dry run); 1: nothing was written, because of a severe finding, or of fewer
    rows than before without `force`."""
    if findings_.where("severe").limit(1).count():
        return Outcome(1, {}, None, findings_)
    rows = cut(rows, "rows")
    dated, undated = sink.routed(rows)
    old = published.current(spark, out, "dated"), published.current(spark, out, "undated")
    excused = reconcile.dated_migrations(dated, undated, *old)
    lost = cut(reconcile.fewer_rows(dated, old[0]).union(reconcile.fewer_rows(undated, old[1], excused)), "lost")
    if not force and lost.limit(1).count():
        return Outcome(1, {}, lost, findings_)
    return Outcome(0, {} if dry else sink.publish(spark, {"dated": dated, "undated": undated}, out), lost, findings_)


def run(spark: SparkSession, given: Inputs, out: str, failed: DataFrame | None = None, redo: bool = False, dry: bool = False, force: bool = False, store: str | None = None) -> Outcome:
    """Builds and publishes: process() and release(). code 1, too, if a page could not be fetched (`failed`).

    Pages that are closed and published already are taken from there unless `redo`; open pages are read again only if
    they have changed, where a store is given."""
    if failed is not None and failed.limit(1).count():
        return Outcome(1, {}, None, spark.createDataFrame([], FINDING))
    before = cut(published.current(spark, out, "dated").union(published.current(spark, out, "undated")), "before")
    kept = before.limit(0) if redo else reusable(before, given.catalog)
    have = kept.select(source_page(F.col("source")).alias("url")).distinct()
    todo = cut(given.catalog.join(have, "url", "left_anti"), "todo")
    if todo.limit(1).count():
        built = process(replace(given, pages=given.pages.join(todo.select("page"), "page", "left_semi"), catalog=todo), store)
    else:
        built = Built(spark.createDataFrame([], MATCH), spark.createDataFrame([], FINDING))
    return release(spark, kept.unionByName(sink.shaped(built.matches, todo)), built.findings, out, dry, force)


def dataset_findings(m: DataFrame, levels: DataFrame) -> DataFrame:
    """Findings over all pages: shared venues and incompatible levels."""
    a = joins.shared_venues(m).select(F.lit("").alias("page"), F.lit("shared_venue").alias("check"), F.lit(False).alias("severe"), F.concat_ws(" / ", "venue", "one", "two").alias("subject"), text(F.col("n_one"), " ", F.col("n_two")).alias("detail"))
    b = reconcile.incompatible_levels(m, levels).select(F.lit(""), F.lit("incompatible_levels"), F.lit(False), F.concat_ws(" ", "club", "season"), F.col("competitions"))
    return a.union(b)


def resolved(ext: DataFrame, registry: DataFrame) -> DataFrame:
    """External matches whose names are the registry's: home_club and away_club by name only."""
    names = entities.name_index(registry)
    got = ext
    for side in ("home", "away"):
        got = got.withColumn(f"__{side}", normalized(F.col(side))).join(names.select(F.col("name").alias(f"__{side}"), F.col("entity").alias(f"{side}_club")), f"__{side}", "left").drop(f"__{side}")
    return got
