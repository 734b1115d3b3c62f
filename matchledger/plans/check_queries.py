"""Queries of the invariant checks over the match view, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.operators import checks
from matchledger.plans.views import SIDES, M, matches, read


def known_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").where("s_suppkey < 17").select(F.concat(F.lit("Club "), F.col("s_suppkey").cast("string")).alias("name"))


def _check(name: str):
    return lambda spark, sf_dir: checks.CHECKS[name](matches(spark, sf_dir))


#: In one competition the fourth matchday is played 300 days before.
EARLY = "CASE WHEN competition = 'RF' AND matchday = 'Fecha 8' AND date <> '' THEN CAST(CAST(date AS DATE) - INTERVAL 300 DAY AS DATE) ELSE CAST(NULLIF(date, '') AS DATE) END"


def year_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matches(spark, sf_dir)
    return checks.year_order(m.withColumn("date", F.coalesce(F.expr(EARLY).cast("string"), F.lit(""))))


QUERIES = {f"check_{name}": _check(name) for name in checks.CHECKS} | {
    "check_unknown_names": lambda spark, sf_dir: checks.unknown_names(matches(spark, sf_dir), known_clubs(spark, sf_dir)),
    "check_year_order": year_order,
    "review": lambda spark, sf_dir: checks.review(matches(spark, sf_dir), known_clubs(spark, sf_dir)).groupBy("check", "severe").agg(F.count("*").alias("findings"), F.count_distinct("page").alias("pages")),
}


def _select(check: str, severe: bool, subject: str, detail: str, rest: str) -> str:
    return f"SELECT page, '{check}' AS \"check\", {str(severe).lower()} AS severe, {subject} AS subject, {detail} AS detail {rest}"


_EARLY_ROWS = f"SELECT * EXCLUDE (date), coalesce(CAST({EARLY} AS VARCHAR), '') AS date FROM m"
_FIRST = "array_to_string(list_sort(list({0}))[1:{1}], ', ')"
_PLAYED = "sides WHERE phase = 'groups'"

#: name -> (tables, selects)
_PARTS: dict[str, tuple[str, list[str]]] = {
    "completeness": (M, [
        _select("no_club", True, "row_id", "''", "FROM m WHERE home = '' OR away = ''"),
        _select("no_score", True, "row_id", "''", "FROM m WHERE hs IS NULL OR aws IS NULL"),
        _select("odd_score", True, "row_id", "hs || '-' || aws", "FROM m WHERE NOT (hs BETWEEN 0 AND 20 AND aws BETWEEN 0 AND 20)"),
    ]),
    "undated": (M, [_select("undated", False, "count(*)::VARCHAR", _FIRST.format("row_id", 3), "FROM m WHERE date = '' GROUP BY page")]),
    "unknown_names": (f"{SIDES}, lone AS (SELECT DISTINCT page, club FROM sides WHERE club <> '' AND club NOT IN (SELECT 'Club ' || s_suppkey FROM supplier WHERE s_suppkey < 17))",
        [_select("unknown_club", True, "count(*)::VARCHAR", _FIRST.format("club", 6), "FROM lone GROUP BY page")]),
    "shootouts": (f"""{M}, s AS (SELECT *, count(*) OVER w AS legs, sum(CASE WHEN home = least(home, away) THEN hs ELSE aws END) OVER w AS a, sum(CASE WHEN home = least(home, away) THEN aws ELSE hs END) OVER w AS b
  FROM m WINDOW w AS (PARTITION BY page, section, matchday, phase, least(home, away), greatest(home, away)))""",
        [_select("shootout_without_draw", True, "row_id", "hs || '-' || aws || ' (' || hpens || '-' || apens || ')'", "FROM s WHERE hpens IS NOT NULL AND hs <> aws AND NOT coalesce(phase = 'knockout' AND legs = 2 AND a = b, false)")]),
    "duplicates": (M, [_select("duplicate", True, "date || ' ' || home || ' ' || away", "count(*)::VARCHAR", "FROM m WHERE date <> '' GROUP BY page, date, home, away HAVING count(*) > 1")]),
    "self_play": (M, [_select("self_play", True, "row_id", "home", "FROM m WHERE home <> '' AND home = away")]),
    "partial_groups": (M, [_select("partial_groups", True, "section", "count(*) FILTER (grp = '') || '/' || count(*)", "FROM m WHERE phase = 'groups' GROUP BY page, section HAVING count(*) FILTER (grp = '') > 0 AND count(*) FILTER (grp = '') < count(*)")]),
    "round_robin": (f"""{SIDES}, clubs AS (SELECT page, grp, club, count(*) AS n FROM {_PLAYED} AND regexp_matches(grp, '(?i)^(zona|grupo)\\b') GROUP BY ALL),
held AS (SELECT page, grp, count(*) AS k, min(n) AS lo, max(n) AS hi, sum(n) AS total FROM clubs GROUP BY ALL)""", [
        _select("unequal_games", False, "grp", "lo || '-' || hi", "FROM held WHERE lo <> hi"),
        _select("incomplete_round_robin", False, "grp", "k || ': ' || total", "FROM held WHERE lo = hi AND k > 1 AND total % (k * (k - 1)) <> 0"),
    ]),
    "once_per_matchday": (f"{SIDES}, twice AS (SELECT page, section, grp, matchday, club FROM {_PLAYED} AND matchday <> '' GROUP BY ALL HAVING count(*) > 1)",
        [_select("twice_a_matchday", True, "section || ' / ' || grp || ' / ' || matchday", _FIRST.format("club", 4), "FROM twice GROUP BY page, section, grp, matchday")]),
    "matchday_gaps": (f"""{M}, days AS (SELECT DISTINCT page, regexp_extract(matchday, '(\\d+)', 1)::INT AS n FROM m WHERE phase = 'groups' AND regexp_matches(matchday, '\\d')),
ends AS (SELECT page, min(n) AS lo, max(n) AS hi FROM days WHERE n > 0 GROUP BY page), every AS (SELECT page, lo, hi, unnest(range(lo, hi + 1)) AS n FROM ends)""",
        [_select("matchday_gap", False, "lo || '-' || hi", "string_agg(n::VARCHAR, ', ' ORDER BY n)", "FROM every ANTI JOIN days USING (page, n) GROUP BY page, lo, hi")]),
    "year_order": (f"""{M}, early AS ({_EARLY_ROWS}),
days AS (SELECT page, regexp_extract(matchday, '(\\d+)', 1)::INT AS n, list_sort(list(date)) AS d FROM early WHERE phase = 'groups' AND date <> '' AND regexp_matches(matchday, '\\d') GROUP BY ALL),
mids AS (SELECT page, n, d[len(d) // 2 + 1] AS mid FROM days WHERE n > 0), seq AS (SELECT *, lag(mid) OVER w AS last, lag(n) OVER w AS last_n FROM mids WINDOW w AS (PARTITION BY page ORDER BY n))""",
        [_select("year_order", True, "n || ' after ' || last_n", "mid || ' ' || last", "FROM seq WHERE date_diff('day', mid::DATE, last::DATE) > 180")]),
    "one_group": (f"{SIDES}, held AS (SELECT page, section, club, grp, count(*) AS n FROM {_PLAYED} AND regexp_matches(grp, '(?i)^(.*- )?(zona|grupo)\\b') GROUP BY ALL)",
        [_select("two_groups", True, "section || ' / ' || club", "string_agg(grp || ' ' || n, ', ' ORDER BY grp)", "FROM held GROUP BY page, section, club HAVING count(*) > 1")]),
    "home_balance": (M, [_select("home_balance", False, "section || ' / ' || grp || ' / ' || least(home, away) || ' / ' || greatest(home, away)", "count(*) FILTER (home = least(home, away)) || '/' || count(*)",
        "FROM m WHERE phase = 'groups' AND matchday <> '' AND home <> '' AND away <> '' GROUP BY page, section, grp, least(home, away), greatest(home, away) HAVING count(*) % 2 = 0 AND (count(*) FILTER (home = least(home, away)) * 2 <> count(*) OR least(home, away) = greatest(home, away))")]),
    "chain": (f"""{M}, stage AS (SELECT page, section FROM m WHERE phase = 'knockout' AND date <> '' GROUP BY ALL HAVING count(*) >= 3),
r AS (SELECT *, dense_rank() OVER (PARTITION BY page, section ORDER BY CASE matchday WHEN 'Octavos' THEN 1 WHEN 'Octavos de final' THEN 1 WHEN 'Cuartos' THEN 2 WHEN 'Semifinal 1' THEN 3 WHEN 'Semifinal 2' THEN 3 ELSE 4 END) AS k,
  CASE WHEN hs > aws THEN home WHEN aws > hs THEN away WHEN hpens IS NULL THEN '' WHEN hpens > apens THEN home ELSE away END AS won
  FROM m SEMI JOIN stage USING (page, section) WHERE phase = 'knockout' AND date <> ''),
plays AS (SELECT page, section, k, row_id, unnest([home, away]) AS club FROM r),
seen AS (SELECT page, section, club, min(k) AS debut FROM plays WHERE club <> '' GROUP BY ALL),
wins AS (SELECT DISTINCT page, section, k + 1 AS k, won AS club FROM r WHERE won <> ''),
drawn AS (SELECT DISTINCT page, section, k + 1 AS k, least(home, away) AS a, greatest(home, away) AS b FROM r WHERE won = '' AND home <> '' AND away <> ''),
free AS (SELECT page, section, k, unnest([a, b]) AS club FROM drawn d WHERE a = b
  OR NOT (EXISTS (FROM plays p WHERE p.page = d.page AND p.section = d.section AND p.k = d.k AND p.club = d.a) AND EXISTS (FROM plays p WHERE p.page = d.page AND p.section = d.section AND p.k = d.k AND p.club = d.b))),
asked AS (SELECT page, section, k, row_id, club, debut FROM plays JOIN seen USING (page, section, club) SEMI JOIN wins USING (page, section, k))""", [
        _select("chain_entrants", False, "section || ' / ' || k", "club", "FROM (SELECT DISTINCT page, section, k, club FROM asked WHERE debut = k)"),
        _select("chain_broken", False, "section || ' / ' || k", "row_id || ' ' || club", "FROM asked ANTI JOIN wins USING (page, section, k, club) ANTI JOIN free USING (page, section, k, club) WHERE debut < k"),
    ]),
}

ORACLE_SQL = {f"check_{name}": f"WITH {tables} {' UNION ALL '.join(selects)}" for name, (tables, selects) in _PARTS.items()}
ORACLE_SQL["review"] = 'SELECT "check", severe, count(*) AS findings, count(DISTINCT page) AS pages FROM (' + " UNION ALL ".join(f"SELECT * FROM ({q})" for q in ORACLE_SQL.values()).replace(_EARLY_ROWS, "SELECT * FROM m") + ") GROUP BY ALL"
