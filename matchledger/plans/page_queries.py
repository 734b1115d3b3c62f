"""Queries of page layouts and second sources: pages are written from orders, and the SQL tells what stands in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.plans.build import cut
from matchledger.plans.views import read
from matchledger.sources import feeds, wikitext

#: Each order as a row of a page; a page holds a range of orders, so that its length does not grow with the table.
ROW = {
    "page": "concat('p', CAST(CAST(floor(o_orderkey / 400) AS BIGINT) AS STRING))",
    "k": "o_orderkey",
    "d": "CAST(day(o_orderdate) AS INT)",
    "home": "concat('Club ', CAST(o_custkey % 9 AS STRING))",
    "away": "concat('Rival ', CAST(o_orderkey % 7 AS STRING))",
    "a": "CAST(o_orderkey % 4 AS INT)",
    "b": "CAST(o_custkey % 3 AS INT)",
}
O = "o AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in ROW.items()) + " FROM orders)"  # noqa: E741


def pages_of(spark: SparkSession, sf_dir: str, line: Column, before: str, after: str = "") -> DataFrame:
    """(page, text): the lines of a page's orders, in their order, between two texts."""
    rows = read(spark, sf_dir, "orders").selectExpr(*(f"{e} AS {c}" for c, e in ROW.items()))
    held = rows.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("k", line.alias("line")))).alias("lines"))  # of one page's range of orders
    return cut(held.select("page", F.concat(F.lit(before), F.array_join(F.transform("lines", lambda x: x["line"]), ""), F.lit(after)).alias("text")), "pages")


def about(pages: DataFrame, layout: str) -> DataFrame:
    return pages.select("page", F.lit(2009).alias("first_year"), F.lit(2010).alias("last_year"), F.lit(8).alias("from_month"), F.lit(layout).alias("layout"))


def told(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


c = F.col


def cup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds of a cup: every fifth match is level and has a shootout, every sixth is not played."""
    score = F.when(c("k") % 6 == 1, "-").when(c("k") % 5 == 0, told(c("a"), "-", c("a"), " <small>(5)</small> - <small>(4)</small>")).otherwise(told(c("a"), "-", c("b")))
    line = told("|-\n| ", c("d"), " de marzo || Ground ", c("b"), " || ", c("home"), " || ", score, " || ", c("away"), "\n")
    pages = pages_of(spark, sf_dir, line, '== Octavos de final ==\n{| class="wikitable"\n! Fecha !! Estadio !! Equipo 1 !! Res. !! Equipo 2\n', "|}\n")
    return wikitext.matches(pages, about(pages, "cup"), cut).select("page", "date", "venue", "home", "away", "hs", "aws", "hpens", "apens", "matchday", "phase")


def two_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ties of two legs, whose days stand in the caption."""
    line = told("|-\n|", c("home"), " ", c("k"), "\n|", c("a"), "-", c("b"), "\n|", c("b"), "–", c("a"), "\n|", c("away"), "\n")
    before = "== Torneo Clausura ==\n=== Llave ===\n{| class=\"wikitable\"\n|+ style=\"x\"| '''Final 10 y 17 de junio'''\n|-\n! Local - Ida\n! Ida\n! Vuelta\n! Local - Vuelta\n"
    pages = pages_of(spark, sf_dir, line, before, "|}\n")
    return wikitext.matches(pages, about(pages, "league"), cut).select("page", "date", "home", "away", "hs", "aws", "phase", "matchday", "section")


def match_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = told(
        "{{Partido\n|local = [[", c("home"), "]]\n|resultado = ", c("a"), ":", c("b"), " (1:0)\n|visita = ", c("away"), "\n|fecha = {{fecha|", c("d"), "|3|2010}}\n|estadio = El {{nowrap|Gran}} Campo\n",
        F.when(c("k") % 5 == 0, "|resultado penalti = 4 - 3\n").otherwise(""), "}}\n",
    )
    pages = pages_of(spark, sf_dir, line, "== Torneo Clausura ==\n==== Final ====\n")
    return wikitext.matches(pages, about(pages, "league"), cut).select("page", "date", "venue", "home", "away", "hs", "aws", "hpens", "apens", "phase", "matchday", "section")


def rowspans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cell of the day fills three rows at every tenth order, two at other even ones, and the rows below have none of their
    own; the ground is a cell of two rows at every fourth. Notes suspend matches or tell the day on which they were played."""
    k = c("k")
    head = (k % 10 == 0) | ((k % 2 == 0) & (k % 10 != 2))  # a day of its own: three rows from 0, two from 4, 6 and 8, one row at 3
    span = F.when(k % 10 == 0, 3).when(k % 2 == 0, 2).otherwise(1)
    day = F.when(head | (k % 10 == 3), told(" || ", F.when(span > 1, told("rowspan=", span, "|")).otherwise(""), c("d"), " de marzo")).otherwise("")
    ground = F.when(k % 4 == 0, told(" || rowspan=2|Ground ", c("a") + c("b"))).when(k % 4 == 1, "").otherwise(" || Ground")
    note = F.when(k % 5 == 0, "<ref>El partido fue suspendido</ref>").when(k % 7 == 1, "<ref>Se jugó el 20 de abril</ref>").otherwise("")
    line = told("|-\n| ", c("home"), " || ", c("a"), " - ", c("b"), " || ", c("away"), ground, day, " || 16:00", note, "\n")
    before = '== Torneo Apertura ==\n=== Resultados ===\n{| class="wikitable"\n! colspan="6" | Interzonales\n|-\n! Local !! Resultado !! Visitante !! Estadio !! Fecha !! Hora\n'
    pages = pages_of(spark, sf_dir, line, before, "|}\n")
    return wikitext.matches(pages, about(pages, "league"), cut).select("page", "date", "time", "home", "away", "hs", "aws", "status", "grp", "section", "venue")


def ambiguous_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stages with a group of one name each, and another that only one stage has: the first are told with their stage."""
    line = told("|-\n| ", c("home"), " ", c("k"), " || ", c("a"), "-", c("b"), " || ", c("away"), "\n")
    rows = read(spark, sf_dir, "orders").selectExpr(*(f"{e} AS {n}" for n, e in ROW.items()))
    held = rows.groupBy("page").agg(F.array_sort(F.collect_list(F.struct((c("k") % 3).alias("part"), "k", line.alias("line")))).alias("ls"))  # of one page's range of orders
    body = lambda part: F.array_join(F.transform(F.filter("ls", lambda x: x["part"] == part), lambda x: x["line"]), "")
    table = lambda label, part: F.concat(F.lit(f'=== Resultados ===\n{{| class="wikitable"\n! colspan="6" | {label}\n'), body(part), F.lit("|}\n"))
    text = F.concat(F.lit("== Primera etapa ==\n"), table("Zona A", 0), F.lit("== Segunda etapa ==\n"), table("Zona A", 1), F.lit("== Tercera etapa ==\n"), table("Zona B", 2))
    pages = cut(held.select("page", text.alias("text")), "pages")
    return wikitext.matches(pages, about(pages, "league"), cut).select("page", "home", "away", "hs", "aws", "grp", "section", "phase")


def standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of standings; every fifth does not close."""
    gf = F.when(c("k") % 5 == 0, c("a") + 1).otherwise(c("a"))
    line = told("|-\n| 1 || [[Art ", c("home"), "|", c("home"), " ", c("k"), "]] || 7 || ", c("a") + c("b"), " || ", c("a"), " || 0 || ", c("b"), " || ", gf, " || ", c("b"), " || ", c("a") - c("b"), "\n")
    pages = pages_of(spark, sf_dir, line, '== Clausura ==\n{| class="wikitable"\n! Pos !! Equipo !! Pts !! PJ !! PG !! PE !! PP !! GF !! GC !! Dif\n', "|}\n")
    return wikitext.standings(pages, keep=cut).select("page", "club", "article", "pj", "gf", "gc", "g", "e", "p", "closes")


def bracket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_of(spark, sf_dir, told("{{Copa de 2\n|RD1-equipo1 = [[Art ", c("home"), "|", c("home"), "]] |RD1-goles1-1 = ", c("a"), " |RD1-goles1-2 = ", c("b"), "\n|RD1-equipo2 = ", c("away"), " ", c("k"), " |RD1-goles2-1 = ", c("b"), " |RD1-goles2-2 = 1\n}}\n"), "Cuadro\n")


def odd_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are void, that speak of a ruling, and whose highlight contradicts the score."""
    plain = told(c("home"), " ", c("k"), " || ", c("a"), "-", c("b"), " || ", c("away"))
    row = F.when(c("k") % 4 == 0, told(c("home"), " ", c("k"), " || PP-PP || ", c("away"))).when(c("k") % 4 == 1, told(plain, " || Según el tribunal, sigue")).when(c("k") % 4 == 2, told("bgcolor=#d0e7ff | ", plain)).otherwise(plain)
    rows = wikitext.all_rows(pages_of(spark, sf_dir, told("|-\n| ", row, "\n"), '{| class="wikitable"\n', "|}\n"))
    kinds = {"void": wikitext.voided(rows), "ruling": wikitext.unread_rulings(rows), "highlight": wikitext.contradicted_highlights(rows)}
    void, ruling, highlight = (df.select("page", F.lit(k).alias("kind"), "home", "away") for k, df in kinds.items())
    return void.union(ruling).union(highlight)


def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A match of each order under its matchday; every third is not finished, and of every fifth the time is not known."""
    line = told(
        '<div class="round-head">Matchday ', c("k") % 30, '</div><div data-match_id="', c("k"), '" class="row ', F.when(c("k") % 3 == 0, "scheduled").otherwise("finished"), '" data-datetime="2010-03-', F.lpad(c("d").cast("string"), 2, "0"), 'T23:30:00Z">',
        '<a href="/x/teams/te', c("a") + 1, '/a">', c("home"), '</a><a href="/x/teams/te', c("a") + 1, '/b"><img></a><span class="', F.when(c("k") % 5 == 0, "match-time-unknown").otherwise("t"), '">21:10</span>',
        '<a href="/x/teams/te', c("a") + 90, '/z">', c("away"), ' &amp; Co</a><div class="match-result big"><a> ', c("a"), ":", c("b"), " </a></div></div>",
    )
    got = feeds.html_matches(pages_of(spark, sf_dir, line, "<html>"))
    return got.select("page", "matchday", "date", "home_id", "away_id", "home", "away", "hs", "aws")


def html_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = told('<option value="', c("k") % 50, '">', c("home"), " &amp; ", c("k"), "</option>")
    return feeds.html_options(pages_of(spark, sf_dir, line, '<select name="se">', "</select>"), "se")


def report_names(pages: DataFrame) -> DataFrame:
    short = F.explode(F.concat(F.transform(F.sequence(F.lit(0), F.lit(8)), lambda i: F.concat(F.lit("Club "), i.cast("string"))), F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.concat(F.lit("Rival "), i.cast("string"))))).alias("short")
    return pages.select("page", F.lit("Zona A").alias("grp"), short).withColumn("club", F.concat(F.lit("FC "), "short"))


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A round of one match for each order; some are decided by a note, some are lost for both."""
    ruled = F.when(c("k") % 4 == 1, told("abd ", c("away"), "        [abandoned at 1-0 in\n  the 80th minute, result stood]")).when(c("k") % 4 == 2, told("awd ", c("away"), "        [awarded 0-2]")).when(c("k") % 4 == 3, told(c("a"), "-", c("b"), " ", c("away"), "  [at Sur]"))
    line = told("Round ", c("k") % 40 + 1, " [Mar ", c("d"), "]\n", c("home"), "              ", F.coalesce(ruled, told("n.p. ", c("away"), "       [lost by ruling against both]")), "\n")
    pages = pages_of(spark, sf_dir, line, "Torneo Apertura\nZona A\n")
    rows, _ = feeds.report_matches(pages, report_names(pages), about(pages, "league"))
    return rows.select("page", "date", "matchday", "home", "away", "hs", "aws", "section", "grp", "status")


def long_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match is decided by a note that runs on beside the match below; names have brackets."""
    line = told(
        "Round ", c("k") % 40 + 1, " [Mar ", c("d"), "]\n", c("home"), " (P)        awd ", c("away"), " (C)      [abandoned at 0-0 (of\n", c("home"), "            ", c("a"), "-", c("b"), " ", c("away"), "      90'), then awarded\n",
        "                              ", c("b") + 1, "-", c("a"), " by (the) board]\n",
    )
    pages = pages_of(spark, sf_dir, line, "Torneo Apertura\nZona A\n")
    short = report_names(pages)
    both = short.withColumn("short", F.explode(F.array("short", F.concat("short", F.lit(" (P)")), F.concat("short", F.lit(" (C)")))))
    rows, _ = feeds.report_matches(pages, both, about(pages, "league"))
    return rows.select("page", "date", "matchday", "home", "away", "hs", "aws", "status")


def report_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = told("First Leg [Jun ", c("d") % 28 + 1, "]\n", c("home"), "          ", c("a"), "-", c("a"), "     ", c("away"), F.when(c("k") % 2 == 0, "     [4-3 pen]").otherwise(""), "\n")
    pages = pages_of(spark, sf_dir, line, "Torneo Final\nZona A\nSemifinals\n")
    rows, _ = feeds.report_ties(pages, report_names(pages), about(pages, "league"))
    return rows.select("page", "date", "home", "away", "hs", "aws", "hpens", "apens", "phase", "matchday", "section")


QUERIES = {
    "cup_pages": cup,
    "two_leg_pages": two_legs,
    "template_pages": match_templates,
    "rowspan_pages": rowspans,
    "ambiguous_groups": ambiguous_groups,
    "report_long_notes": long_notes,
    "standings_pages": standings,
    "bracket_slots": lambda s, d: wikitext.bracket_slots(bracket(s, d)).select("page", "rd", "slot", "name", "article"),
    "bracket_legs": lambda s, d: wikitext.bracket_legs(bracket(s, d)).select("page", "one", "two", "leg", "a", "b"),
    "odd_rows": odd_rows,
    "html_blocks": html_blocks,
    "html_options": html_options,
    "report_matches": reports,
    "report_ties": report_ties,
}

_MARCH = "printf('2010-03-%02d', d)"
ORACLE_SQL = {
    "cup_pages": f"""WITH {O} SELECT page, {_MARCH} AS date, concat('Ground ', b) AS venue, home, away, a AS hs, CASE WHEN k % 5 = 0 THEN a ELSE b END AS aws, CASE WHEN k % 5 = 0 THEN 5 END AS hpens, CASE WHEN k % 5 = 0 THEN 4 END AS apens,
  'Octavos' AS matchday, 'knockout' AS phase FROM o WHERE k % 6 <> 1""",
    "two_leg_pages": f"""WITH {O} SELECT page, '2010-06-10' AS date, concat(home, ' ', k) AS home, away, a AS hs, b AS aws, 'knockout' AS phase, 'Final' AS matchday, 'Torneo Clausura' AS section FROM o
UNION ALL SELECT page, '2010-06-17', away, concat(home, ' ', k), a, b, 'knockout', 'Final', 'Torneo Clausura' FROM o""",
    "template_pages": f"""WITH {O} SELECT page, {_MARCH} AS date, 'El Gran Campo' AS venue, home, away, a AS hs, b AS aws, CASE WHEN k % 5 = 0 THEN 4 END AS hpens, CASE WHEN k % 5 = 0 THEN 3 END AS apens,
  'knockout' AS phase, 'Final' AS matchday, 'Torneo Clausura' AS section FROM o""",
    "rowspan_pages": f"""WITH {O}, h AS (SELECT *, k - CASE WHEN k % 10 <= 2 THEN k % 10 WHEN k % 10 = 3 THEN 0 ELSE k % 2 END AS day_of, k - k % 4 % 2 * (k % 4 = 1)::INT AS ground_of FROM o),
t AS (SELECT h.*, x.d AS day, y.a + y.b AS ground FROM h JOIN o x ON x.k = day_of JOIN o y ON y.k = ground_of)
SELECT page, CASE WHEN k % 7 = 1 AND k % 5 <> 0 THEN '2010-04-20' ELSE printf('2010-03-%02d', day) END AS date, '16:00' AS time, home, away, a AS hs, b AS aws, CASE WHEN k % 5 = 0 THEN 'suspended' ELSE '' END AS status, 'Interzonal' AS grp, 'Torneo Apertura' AS section,
  CASE WHEN k % 4 <= 1 THEN 'Ground ' || ground ELSE 'Ground' END AS venue FROM t""",
    "ambiguous_groups": f"""WITH {O} SELECT page, concat(home, ' ', k) AS home, away, a AS hs, b AS aws, CASE k % 3 WHEN 0 THEN 'Primera etapa - Zona A' WHEN 1 THEN 'Segunda etapa - Zona A' ELSE 'Zona B' END AS grp,
  CASE k % 3 WHEN 0 THEN 'Primera etapa' WHEN 1 THEN 'Segunda etapa' ELSE 'Tercera etapa' END AS section, 'groups' AS phase FROM o""",
    "report_long_notes": f"""WITH {O} SELECT page, {_MARCH} AS date, (k % 40 + 1)::INT AS matchday, concat('FC ', home) AS home, concat('FC ', away) AS away, b + 1 AS hs, a AS aws, 'suspended' AS status FROM o
UNION ALL SELECT page, {_MARCH}, (k % 40 + 1)::INT, concat('FC ', home), concat('FC ', away), a, b, '' FROM o""",
    "standings_pages": f"""WITH {O} SELECT page, concat(home, ' ', k) AS club, concat('Art ', home) AS article, a + b AS pj, a + (k % 5 = 0)::INT AS gf, b AS gc, a AS g, 0 AS e, b AS p, k % 5 <> 0 AS closes FROM o""",
    "bracket_slots": f"""WITH {O} SELECT page, 1 AS rd, 1 AS slot, home AS name, concat('Art ', home) AS article FROM o UNION ALL SELECT page, 1, 2, concat(away, ' ', k), '' FROM o""",
    "bracket_legs": f"""WITH {O} SELECT page, home AS one, concat(away, ' ', k) AS two, 1 AS leg, a, b FROM o UNION ALL SELECT page, home, concat(away, ' ', k), 2, b, 1 FROM o""",
    "odd_rows": f"""WITH {O} SELECT page, CASE k % 4 WHEN 0 THEN 'void' WHEN 1 THEN 'ruling' ELSE 'highlight' END AS kind, concat(home, ' ', k) AS home, away FROM o WHERE k % 4 < 2 OR (k % 4 = 2 AND a <= b)""",
    "html_blocks": f"""WITH {O} SELECT page, (k % 30)::INT AS matchday, CAST(DATE '2010-03-01' + CAST(d - 1 AS INT) + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS VARCHAR)[1:10] AS date, concat('te', a + 1) AS home_id, concat('te', a + 90) AS away_id,
  home, concat(away, ' & Co') AS away, a AS hs, b AS aws FROM o WHERE k % 3 <> 0""",
    "html_options": f"""WITH {O} SELECT page, (k % 50)::VARCHAR AS value, arg_max(concat(home, ' & ', k), k) AS label FROM o GROUP BY ALL""",
    "report_matches": f"""WITH {O} SELECT page, {_MARCH} AS date, (k % 40 + 1)::INT AS matchday, concat('FC ', home) AS home, concat('FC ', away) AS away, CASE k % 4 WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE a END AS hs, CASE k % 4 WHEN 1 THEN 0 WHEN 2 THEN 2 ELSE b END AS aws,
  'Torneo Apertura' AS section, 'Zona A' AS grp, CASE k % 4 WHEN 1 THEN 'suspended' WHEN 2 THEN 'desk' ELSE '' END AS status FROM o WHERE k % 4 <> 0""",
    "report_ties": f"""WITH {O} SELECT page, printf('2010-06-%02d', d % 28 + 1) AS date, concat('FC ', home) AS home, concat('FC ', away) AS away, a AS hs, a AS aws, CASE WHEN k % 2 = 0 THEN 4 END AS hpens, CASE WHEN k % 2 = 0 THEN 3 END AS apens,
  'knockout' AS phase, 'Semifinals' AS matchday, 'Torneo Final' AS section FROM o""",
}
