"""Queries of reconciliation over the match view. The published standings are our own with some figures changed, so that every branch has rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.functions.text import label_number
from matchledger.operators import reconcile
from matchledger.plans.views import SIDES, M, matches, read

#: Changed figures: n is the club's number, y the page's year.
CHANGED = {
    "pj": "pj + CASE WHEN scope = 'Etapa 3' AND n % 3 <> 0 THEN 1 WHEN scope <> 'Etapa 1' AND (n + y) % 9 = 0 THEN 1 ELSE 0 END",
    "gf": "gf + CASE WHEN (n + y) % 5 = 1 THEN 1 ELSE 0 END",
    "gc": "gc",
    "g": "g + CASE WHEN (n * 3 + y) % 11 = 2 THEN 1 ELSE 0 END",
    "e": "e - CASE WHEN (n * 3 + y) % 11 = 2 THEN 1 ELSE 0 END",
    "p": "p",
}
_CASTS = [f"CAST({e} AS BIGINT) AS {c}" for c, e in CHANGED.items()]
_CHANGED = ", ".join(_CASTS)


def _numbered(df: DataFrame) -> DataFrame:
    return df.withColumn("n", label_number(F.col("club"))).withColumn("y", F.substring("page", 4, 4).cast("int"))


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(reconcile.scoped_totals(matches(spark, sf_dir))).selectExpr("page", "scope", "club", *_CASTS)


def waivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = matches(spark, sf_dir).select("page").distinct()
    return pages.select("page", F.explode(F.array(F.lit("Club 3"), F.lit("Club 11"), F.lit("Club 99"))).alias("club"))


def both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return published(spark, sf_dir), matches(spark, sf_dir)


def with_ghosts(pub: DataFrame) -> DataFrame:
    return pub.withColumn("club", F.when(label_number(F.col("club")) == 7, "Ghost 7").otherwise(F.col("club")))


def merge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pub = published(spark, sf_dir)
    again = _numbered(pub).withColumn("pj", F.col("pj") + (F.col("n") % 3) - 1).withColumn("gf", F.lit(0).cast("long")).drop("n", "y").withColumn("seq", F.lit(2))
    return reconcile.merged(pub.withColumn("seq", F.lit(1)).unionByName(again))


def table_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events").selectExpr("concat('u', CAST(user_id % 20 AS STRING)) AS page", "event_id AS pos", "event_type", "concat('Etapa ', CAST(event_id % 6 AS STRING)) AS title")
    heads = ev.where("event_type IN ('error', 'click')").select("page", "pos", F.when(F.col("event_type") == "error", 2).otherwise(3).alias("level"), "title")
    stages = read(spark, sf_dir, "orders").selectExpr("concat('u', CAST(o_custkey % 20 AS STRING)) AS page", "'groups' AS phase", "concat(CASE WHEN o_orderkey % 4 = 0 THEN 'Etapa ' ELSE 'Otra ' END, CAST(o_orderkey % 6 AS STRING)) AS section")
    return reconcile.table_scopes(ev.where("event_type = 'view'").select("page", "pos"), heads, stages)


def closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    pub = _numbered(published(spark, sf_dir)).withColumn("diff", c("gf") - c("gc") + F.when(c("n") % 6 == 2, 1).otherwise(0))
    why = reconcile.closes(c("gf"), c("gc"), c("diff"), c("g"), c("e"), c("p"), c("pj"))
    return pub.select("page", "scope", "club", why.alias("why")).where("why <> ''")


def highlights(spark: SparkSession, sf_dir: str) -> DataFrame:
    pub, m = both(spark, sf_dir)
    accused = m.where("phase = 'groups' and hs > aws and matchday = 'Fecha 6'").select("page", "row_id", "home", "away")
    return reconcile.unanswered_highlights(accused, pub, m)


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return part.selectExpr("concat(p_name, ' (', p_brand, ')') AS entity", "concat(upper(substr(p_name, 1, 1)), substr(p_name, 2), CASE WHEN p_size % 2 = 0 THEN ' (x)' ELSE '' END) AS name").distinct()


def bracket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clubs 10 to 25 of each page; the registry knows none from 24 on; 20 and 21 have namesakes."""
    pages = matches(spark, sf_dir).select("page").distinct()
    named = pages.select("page", F.explode(F.sequence(F.lit(10), F.lit(25))).alias("n")).withColumn("written", F.concat(F.lit("Club "), "n"))
    return named.select("page", "written", F.when(F.col("n") < 24, F.when(F.col("n") < 22, F.col("written")).otherwise(F.concat("written", F.lit(" (Sur)")))).alias("club"))


def club_names(spark: SparkSession) -> DataFrame:
    """Entities Club 0 .. Club 23; Club 20 and 21 share an alias' base with Club 5, and Club 22 with Club 6."""
    return spark.range(24).selectExpr("concat('Club ', CAST(id AS STRING), CASE WHEN id >= 22 THEN ' (Sur)' ELSE '' END) AS entity", "CASE WHEN id IN (20, 21) THEN 'Club 5 (Norte)' WHEN id = 22 THEN 'Club 6 (Sur)' ELSE concat('Club ', CAST(id AS STRING)) END AS name")


def bracket_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.bracket_clubs(bracket(spark, sf_dir), matches(spark, sf_dir), club_names(spark))


def bare_namesakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matches(spark, sf_dir)
    pages = m.select("page").distinct()
    linked = pages.select("page", F.explode(F.array(F.lit("Club 20"), F.lit("Club 22 (Sur)"), F.lit("Club 1"), F.lit("Club 6"))).alias("club")).where("page < 'N' or club <> 'Club 6'")
    tabulated = pages.select("page", F.explode(F.array(F.lit("Club 20"), F.lit("Club 22 (Sur)"))).alias("club"))
    return reconcile.bare_namesakes(m, tabulated, linked, club_names(spark))


def bracket_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matches(spark, sf_dir)
    legs = m.where("matchday IN ('Final', 'Fecha 14') and home <> ''").select("page", F.col("home").alias("one"), F.when(F.col("aws") == 5, "Club 77").otherwise(F.col("away")).alias("two"), (F.col("hs") + 3).alias("a"), F.col("aws").alias("b")).distinct()
    waived = m.select("page").distinct().select("page", F.lit("Club 4").alias("one"), F.lit("Club 2").alias("two"))
    return reconcile.bracket_scores(legs, m, waived)


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    rows = read(spark, sf_dir, "lineitem").selectExpr("concat(l_returnflag, l_linestatus) AS tournament", "CAST(year(l_shipdate) AS INT) AS season", "CAST(CAST(l_shipdate AS DATE) AS STRING) AS date", "l_orderkey AS k", "l_suppkey % 5 AS s")
    return rows.where("k % 3 = 0 and not (season = 1997 and s < 4)"), rows.where("k % 3 = 1 and s = 0"), rows.where("k % 3 = 2 and not (season = 1996 and tournament = 'AF')"), rows.where("k % 3 = 2 and s = 1")


def regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated, undated, old_dated, old_undated = halves(spark, sf_dir)
    excused = reconcile.dated_migrations(dated, undated, old_dated, old_undated)
    lost = reconcile.fewer_rows(dated, old_dated).withColumn("part", F.lit("dated"))
    return lost.union(reconcile.fewer_rows(undated, old_undated, excused).withColumn("part", F.lit("undated")))


def migrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.dated_migrations(*halves(spark, sf_dir))


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.createDataFrame([("AF", 1), ("AO", 2), ("NF", 3), ("RF", 4)], "competition string, level int")
    return reconcile.incompatible_levels(matches(spark, sf_dir), given)


def blanked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.false_matchdays(matches(spark, sf_dir)).select("page", "row_id", "matchday", "blanked")


QUERIES = {
    "standings": lambda s, d: reconcile.totals(matches(s, d), "competition", "season"),
    "standings_scoped": lambda s, d: reconcile.scoped_totals(matches(s, d)),
    "published_vs_computed": lambda s, d: reconcile.goals_differ(*both(s, d), waivers(s, d)),
    "results_differ": lambda s, d: reconcile.results_differ(*both(s, d), waivers(s, d)),
    "games_played_ratio_guard": lambda s, d: reconcile.games_differ(*both(s, d), waivers(s, d)),
    "balance_check": lambda s, d: reconcile.unbalanced(*both(s, d)),
    "deviating_clubs": lambda s, d: reconcile.deviating(*both(s, d)),
    "stale_waivers": lambda s, d: reconcile.stale_waivers(waivers(s, d), *both(s, d)),
    "without_matches": lambda s, d: reconcile.without_matches(with_ghosts(published(s, d)), matches(s, d)),
    "standings_merge": merge_rows,
    "table_scopes": table_scopes,
    "rows_that_do_not_close": closing,
    "unanswered_highlights": highlights,
    "namesakes": lambda s, d: reconcile.namesakes(part_names(s, d)),
    "bare_namesakes": bare_namesakes,
    "bracket_clubs": bracket_clubs,
    "bracket_scores": bracket_scores,
    "false_label_blanking": blanked,
    "regression_counts": regression,
    "dated_migrations": migrations,
    "incompatible_levels": levels,
}

_SUMS = "sum(pj)::BIGINT AS pj, sum(gf)::BIGINT AS gf, sum(gc)::BIGINT AS gc, sum(g)::BIGINT AS g, sum(e)::BIGINT AS e, sum(p)::BIGINT AS p"
_COUNTS = "count(*) AS pj, sum(gf)::BIGINT AS gf, sum(gc)::BIGINT AS gc, count(*) FILTER (gf > gc) AS g, count(*) FILTER (gf = gc) AS e, count(*) FILTER (gf < gc) AS p"
_PLAYED = "FROM sides WHERE phase = 'groups' AND hs IS NOT NULL AND aws IS NOT NULL"
OURS = f"""{SIDES}, tot AS (SELECT page, section AS scope, club, {_COUNTS} {_PLAYED} GROUP BY ALL),
ours AS (SELECT page, '' AS scope, club, {_SUMS} FROM tot GROUP BY page, club UNION ALL SELECT * FROM tot)"""
PUB = f"""{OURS}, pub AS (SELECT page, scope, club, {_CHANGED} FROM (SELECT *, coalesce(try_cast(regexp_extract(club, '(\\d+)', 1) AS INT), 0) AS n, CAST(substr(page, 4, 4) AS INT) AS y FROM ours)),
cmp AS (SELECT pub.*, o.pj AS o_pj, o.gf AS o_gf, o.gc AS o_gc, o.g AS o_g, o.e AS o_e, o.p AS o_p FROM pub JOIN ours o USING (page, scope, club)),
wide AS (SELECT * FROM cmp QUALIFY row_number() OVER (PARTITION BY page, club ORDER BY pj DESC, scope) = 1),
waived AS (SELECT DISTINCT page, unnest(['Club 3', 'Club 11', 'Club 99']) AS club FROM m)"""
_NUM = "coalesce(try_cast(regexp_extract({0}, '(\\d+)', 1) AS INT), 0)"
_BASE = "trim(regexp_replace(lower(regexp_replace(name, '\\s*\\([^)]*\\)\\s*$', '')), '\\s+', ' ', 'g'))"
_CLUB_NAMES = "cn AS (SELECT concat('Club ', id, CASE WHEN id >= 22 THEN ' (Sur)' ELSE '' END) AS entity, CASE WHEN id IN (20, 21) THEN 'Club 5 (Norte)' WHEN id = 22 THEN 'Club 6 (Sur)' ELSE concat('Club ', id) END AS name FROM range(24) t(id))"
_NEAR = f"{_CLUB_NAMES}, nb AS (SELECT DISTINCT entity, {_BASE} AS base FROM cn), near AS (SELECT DISTINCT a.entity, b.entity AS other FROM nb a JOIN nb b USING (base) WHERE a.entity <> b.entity)"
_LEG = "CASE WHEN {0} <= {1} THEN concat_ws('|', {0}, {1}, {2}, {3}) ELSE concat_ws('|', {1}, {0}, {3}, {2}) END"
_HALVES = """r AS (SELECT concat(l_returnflag, l_linestatus) AS tournament, CAST(year(l_shipdate) AS INT) AS season, l_orderkey AS k, l_suppkey % 5 AS s FROM lineitem),
d1 AS (SELECT tournament, season, count(*) AS n FROM r WHERE k % 3 = 0 AND NOT (season = 1997 AND s < 4) GROUP BY ALL), u1 AS (SELECT tournament, season, count(*) AS n FROM r WHERE k % 3 = 1 AND s = 0 GROUP BY ALL),
d0 AS (SELECT tournament, season, count(*) AS n FROM r WHERE k % 3 = 2 AND NOT (season = 1996 AND tournament = 'AF') GROUP BY ALL), u0 AS (SELECT tournament, season, count(*) AS n FROM r WHERE k % 3 = 2 AND s = 1 GROUP BY ALL),
mig AS (SELECT u0.tournament, u0.season FROM u0 LEFT JOIN u1 USING (tournament, season) LEFT JOIN d0 USING (tournament, season) LEFT JOIN d1 USING (tournament, season) WHERE coalesce(u1.n, 0) < u0.n AND coalesce(d1.n, 0) > coalesce(d0.n, 0))"""

ORACLE_SQL = {
    "standings": f"WITH {SIDES} SELECT page, competition, season, club, {_COUNTS} {_PLAYED} GROUP BY ALL",
    "standings_scoped": f"WITH {OURS} SELECT * FROM ours",
    "published_vs_computed": f"WITH {PUB} SELECT page, club, pj, gf, gc, o_gf, o_gc, n_deviating FROM (SELECT *, count(*) OVER (PARTITION BY page) AS n_deviating FROM wide WHERE pj = o_pj AND (gf <> o_gf OR gc <> o_gc)) ANTI JOIN waived USING (page, club)",
    "results_differ": f"WITH {PUB} SELECT page, club, pj, g, e, p, o_g, o_e, o_p, CASE WHEN gf = o_gf AND gc = o_gc THEN 'table' ELSE 'match' END AS blame FROM wide ANTI JOIN waived USING (page, club) WHERE pj = o_pj AND NOT (g = o_g AND e = o_e AND p = o_p)",
    "games_played_ratio_guard": f"""WITH {PUB}, f AS (SELECT *, count(*) OVER w AS clubs, count(*) FILTER (pj <> o_pj) OVER w AS n_off FROM cmp WINDOW w AS (PARTITION BY page, scope)),
kept AS (SELECT *, o_pj - pj AS delta FROM f ANTI JOIN waived USING (page, club) WHERE pj <> o_pj AND n_off * 2 <= clubs)
SELECT page, scope, club, pj, o_pj, delta, clubs, count(*) OVER (PARTITION BY page, scope, delta) = 2 AS is_pair FROM kept""",
    "balance_check": f"""WITH {PUB} SELECT page, scope, sum(pub.gf)::BIGINT AS gf, sum(pub.gc)::BIGINT AS gc FROM pub FULL JOIN ours USING (page, scope, club) GROUP BY page, scope
HAVING bool_and(coalesce(pub.pj = ours.pj, false)) AND sum(pub.gf) <> sum(pub.gc)""",
    "deviating_clubs": f"WITH {PUB} SELECT DISTINCT page, club FROM cmp WHERE pj <> o_pj OR gf <> o_gf OR gc <> o_gc OR g <> o_g OR e <> o_e OR p <> o_p",
    "stale_waivers": f"WITH {PUB} SELECT page, club FROM waived ANTI JOIN (SELECT page, club FROM cmp WHERE pj <> o_pj OR gf <> o_gf OR gc <> o_gc OR g <> o_g OR e <> o_e OR p <> o_p) USING (page, club)",
    "without_matches": f"""WITH {PUB}, g AS (SELECT page, scope, CASE WHEN {_NUM.format("club")} = 7 THEN 'Ghost 7' ELSE club END AS club FROM pub)
SELECT page, club, min(scope) AS scope FROM g WHERE NOT EXISTS (FROM sides s WHERE s.page = g.page AND s.club = g.club AND (g.scope = '' OR g.scope = s.section)) GROUP BY page, club""",
    "standings_merge": f"""WITH {PUB} SELECT page, scope, club, pj, gf, gc, g, e, p FROM (SELECT *, 1 AS seq FROM pub UNION ALL SELECT page, scope, club, pj + {_NUM.format("club")} % 3 - 1, 0, gc, g, e, p, 2 FROM pub)
QUALIFY row_number() OVER (PARTITION BY page, scope, club ORDER BY pj DESC, seq) = 1""",
    "table_scopes": """WITH ev AS (SELECT concat('u', user_id % 20) AS page, event_id AS pos, event_type, concat('Etapa ', event_id % 6) AS title FROM events),
st AS (SELECT DISTINCT concat('u', o_custkey % 20) AS page, concat(CASE WHEN o_orderkey % 4 = 0 THEN 'Etapa ' ELSE 'Otra ' END, o_orderkey % 6) AS title FROM orders),
h AS (SELECT t.page, t.pos, (SELECT arg_max(title, e.pos) FROM ev e WHERE e.page = t.page AND e.pos <= t.pos AND e.event_type = 'error') AS title FROM ev t WHERE event_type = 'view')
SELECT page, pos, CASE WHEN (page, title) IN (SELECT (page, title) FROM st) THEN title ELSE '' END AS scope FROM h""",
    "rows_that_do_not_close": f"""WITH {PUB}, c AS (SELECT page, scope, club, concat_ws('; ', CASE WHEN {_NUM.format("club")} % 6 = 2 THEN concat('difference ', gf - gc + 1, ' is not ', gf - gc) END, CASE WHEN g + e + p <> pj THEN concat('played ', pj, ' is not ', g + e + p) END) AS why FROM pub) SELECT * FROM c WHERE why <> ''""",
    "unanswered_highlights": f"""WITH {PUB}, ok AS (SELECT DISTINCT page, club FROM cmp WHERE g = o_g AND e = o_e AND p = o_p)
SELECT page, row_id, home, away FROM m WHERE phase = 'groups' AND hs > aws AND matchday = 'Fecha 6'
  AND NOT (EXISTS (FROM ok WHERE ok.page = m.page AND ok.club = m.home) AND EXISTS (FROM ok WHERE ok.page = m.page AND ok.club = m.away))""",
    "namesakes": f"""WITH n AS (SELECT DISTINCT concat(p_name, ' (', p_brand, ')') AS entity, p_name AS name FROM part), b AS (SELECT entity, {_BASE} AS base FROM n)
SELECT DISTINCT x.entity, y.entity AS other FROM b x JOIN b y USING (base) WHERE x.entity <> y.entity""",
    "bare_namesakes": f"""WITH {SIDES}, {_NEAR}, linked AS (SELECT DISTINCT page, c AS club FROM m, unnest(['Club 20', 'Club 22 (Sur)', 'Club 1', 'Club 6']) t(c) WHERE page < 'N' OR c <> 'Club 6')
SELECT DISTINCT page, club, other FROM sides JOIN near ON club = entity ANTI JOIN linked USING (page, club) WHERE other IN ('Club 20', 'Club 22 (Sur)')""",
    "bracket_clubs": f"""WITH {SIDES}, {_NEAR}, b AS (SELECT DISTINCT page, n, CASE WHEN n < 22 THEN concat('Club ', n) WHEN n < 24 THEN concat('Club ', n, ' (Sur)') END AS club FROM m, range(10, 26) t(n)),
play AS (SELECT DISTINCT page, club FROM sides), out AS (SELECT page, club FROM b ANTI JOIN play USING (page, club) WHERE club IS NOT NULL),
nm AS (SELECT o.page, o.club, p.club AS other FROM out o JOIN near ON o.club = entity JOIN play p ON p.page = o.page AND p.club = near.other)
SELECT page, 'unknown' AS kind, concat('Club ', n) AS club, '' AS detail FROM b WHERE club IS NULL
UNION ALL SELECT page, 'namesake', club, string_agg(other, ', ' ORDER BY other) FROM nm GROUP BY page, club
UNION ALL SELECT page, 'absent', count(*)::VARCHAR, array_to_string(list_sort(list(club))[1:6], ', ') FROM out ANTI JOIN nm USING (page, club) GROUP BY page""",
    "bracket_scores": f"""WITH {M}, legs AS (SELECT DISTINCT page, home AS one, CASE WHEN aws = 5 THEN 'Club 77' ELSE away END AS two, hs + 3 AS a, aws AS b FROM m WHERE matchday IN ('Final', 'Fecha 14') AND home <> ''),
have AS (SELECT DISTINCT page, {_LEG.format("home", "away", "hs", "aws")} AS leg FROM m), met AS (SELECT page, least(home, away) AS lo, greatest(home, away) AS hi, bool_or(phase = 'knockout') AS ko FROM m GROUP BY ALL)
SELECT l.page, one, two, a, b, CASE WHEN ko THEN 'other_score' WHEN ko IS NOT NULL THEN 'only_groups' ELSE 'never' END AS kind
FROM (SELECT x.* FROM (SELECT *, {_LEG.format("one", "two", "a", "b")} AS leg FROM legs) x ANTI JOIN have USING (page, leg)) l
LEFT JOIN met ON met.page = l.page AND lo = least(one, two) AND hi = greatest(one, two) WHERE NOT (least(one, two) = 'Club 2' AND greatest(one, two) = 'Club 4')""",
    "false_label_blanking": f"""WITH {SIDES}, c AS (SELECT page, section, grp, matchday, club, count(*) AS n FROM sides WHERE phase = 'groups' AND matchday <> '' GROUP BY ALL),
f AS (SELECT page, section, grp, matchday, 'groups' AS phase, true AS bad FROM c GROUP BY ALL HAVING sum(n) / 2 > count(*) AND max(n) > 1)
SELECT page, row_id, CASE WHEN bad THEN '' ELSE matchday END AS matchday, coalesce(bad, false) AS blanked FROM m LEFT JOIN f USING (page, section, grp, matchday, phase)""",
    "regression_counts": f"""WITH {_HALVES} SELECT tournament, season, d0.n AS had, coalesce(d1.n, 0) AS has, d1.n IS NULL AS vanished, 'dated' AS part FROM d0 LEFT JOIN d1 USING (tournament, season) WHERE coalesce(d1.n, 0) < d0.n
UNION ALL SELECT tournament, season, u0.n, coalesce(u1.n, 0), u1.n IS NULL, 'undated' FROM u0 LEFT JOIN u1 USING (tournament, season) ANTI JOIN mig USING (tournament, season) WHERE coalesce(u1.n, 0) < u0.n""",
    "dated_migrations": f"WITH {_HALVES} SELECT * FROM mig",
    "incompatible_levels": f"""WITH {SIDES}, r AS (SELECT club, season, competition, CASE competition WHEN 'AF' THEN 1 WHEN 'AO' THEN 2 WHEN 'NF' THEN 3 ELSE 4 END AS level FROM sides WHERE competition IN ('AF', 'AO', 'NF', 'RF'))
SELECT club, season, max(level) - min(level) AS apart, string_agg(DISTINCT competition, ', ' ORDER BY competition) AS competitions FROM r GROUP BY club, season HAVING max(level) - min(level) >= 2""",
}
