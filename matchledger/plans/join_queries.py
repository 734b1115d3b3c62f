"""Queries of joins, entities and amendments over the match view, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.functions.text import normalized
from matchledger.operators import amend, entities, joins
from matchledger.plans.views import EXTERNAL, MATCH, M, X, external, matches, read, select, sql
from matchledger.sinks.shared import cut

#: Finer pages, so that scores are often unique in a matchday.
FINER = {"page": "concat(CAST(l_orderkey % 400 AS STRING), ' ', {0})"}


def finer(view: dict[str, str]) -> dict[str, str]:
    return view | {"page": FINER["page"].format(view["page"])}


def voting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All matches, on finer pages."""
    line = read(spark, sf_dir, "lineitem")
    return joins.vote_mapping(line.selectExpr(*select(finer(MATCH))), line.selectExpr(*select(finer(EXTERNAL))))


def resolved_external(spark: SparkSession, sf_dir: str, fold: bool = False) -> DataFrame:
    """By id for clubs under 10, by the registry's names for those from 8 on; club 15 is in neither. fold: as joins.folded() has them."""
    ext = external(spark, sf_dir)
    if fold:
        ext = joins.folded(ext, cut)
    n = F.explode(F.sequence(F.lit(0), F.lit(9)).cast("array<string>")).alias("n")
    mapping = ext.select("page").distinct().select("page", n).select("page", F.concat(F.lit("t"), "n").alias("ext_id"), F.concat(F.lit("Club "), "n").alias("club"))
    names = spark.range(8, 20).where("id <> 15").select(F.concat(F.lit("Club "), F.col("id").cast("string")).alias("entity")).select(normalized(F.col("entity")).alias("name"), "entity")
    return joins.named(ext, mapping, names)


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matches(spark, sf_dir)
    settled = m.where("home = 'Club 7' and season = 1998").select("page", "matchday", "home", "away")
    got = joins.verified_fill(m, resolved_external(spark, sf_dir, fold=True), "second", settled)
    return got.where("fill is not null").select("page", "row_id", "date", "date_credit", "fill")


def out_of_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("k"), F.col("o_orderdate").cast("date").cast("string").alias("ordered"))
    m = matches(spark, sf_dir).withColumn("k", F.substring_index("row_id", "-", 1)).join(orders, "k")
    imported = m.withColumn("date", F.col("ordered")).withColumn("date_credit", F.when(F.col("hs") < 4, "second").otherwise("")).drop("k", "ordered")
    seasons = m.select("page", F.col("season").alias("first_year"), F.when(F.col("season") == 1997, 1996).alias("last_year")).distinct()
    return joins.in_season(imported, seasons).select("page", "row_id", "date", "date_credit", "cleared")


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matches(spark, sf_dir).where("date <> ''")
    ties = m.where("phase = 'knockout' and matchday IN ('Final', 'Cuartos')")
    shift = F.when(F.col("hs") >= 3, F.col("hs")).otherwise(0)
    ties = ties.select("page", "row_id", F.date_add(F.col("date").cast("date"), shift).cast("string").alias("date"), F.col("away").alias("home"), F.col("home").alias("away"))
    return joins.without_repeats(ties, m.where("matchday <> 'Cuartos' or aws <> 2"))


def venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").selectExpr("p_brand AS venue", "CASE WHEN p_size % 3 = 0 THEN split(p_name, ' ')[0] WHEN p_size % 3 = 1 THEN concat(p_name, ' (', p_type, ')') ELSE p_name END AS home", "p_size > 45 AS neutral")
    waived = spark.createDataFrame([("Brand#2", "red widget"), ("Brand#17", "blue")], "venue string, club string")
    return joins.shared_venues(part, waived)


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events").selectExpr("concat('u', CAST(user_id % 10 AS STRING)) AS page", "event_id AS pos", "event_type")
    read_spans = ev.where("event_type = 'error'").selectExpr("page", "pos AS start", "pos + (pos % 7) * 5 AS end")
    return joins.outside_spans(ev.where("event_type <> 'error'"), read_spans)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").select(F.col("n_name").alias("entity"), F.col("n_nationkey").alias("ext_id"), F.array(F.concat(F.lit("Ñación "), F.col("n_nationkey").cast("string")), F.concat(F.lit("N. "), F.col("n_nationkey").cast("string"))).alias("aliases"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.concat(F.lit("Artículo "), F.col("n_nationkey").cast("string")).alias("article"), F.col("n_name").alias("entity"))


def written(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "CASE c_custkey % 5 WHEN 0 THEN concat('NATION_', CAST(c_nationkey AS STRING)) WHEN 1 THEN concat('  ñacion   ', CAST(c_nationkey AS STRING)) WHEN 2 THEN concat('n ', CAST(c_nationkey AS STRING)) WHEN 3 THEN 'nobody' ELSE '' END"
    article = "CASE WHEN c_custkey % 7 < 3 THEN concat('ARTICULO ', CAST(c_custkey % 27 AS STRING)) ELSE '' END"
    return read(spark, sf_dir, "customer").selectExpr("c_custkey", "concat('p', CAST(c_custkey % 9 AS STRING)) AS page", f"{name} AS name", f"{article} AS article")


def resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg = registry(spark, sf_dir)
    names, arts = entities.name_index(reg), entities.article_index(articles(spark, sf_dir), reg)
    return entities.resolve(written(spark, sf_dir), "name", "article", names, arts, "entity").select("c_custkey", "entity")


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = entities.canonized(written(spark, sf_dir).drop("article"), "name", None, entities.name_index(registry(spark, sf_dir)))
    aliases = spark.createDataFrame([("p0", "NATION_3", "NATION_3 (p0)"), ("p1", "nobody", "somebody"), ("p1", "never", "x")], "page string, name string, entity string")
    return entities.page_aliases(rows, "name", aliases)


def sure_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that must all be known."""
    own = written(spark, sf_dir).where("name not in ('', 'nobody')").select("c_custkey", "name")
    return entities.strict(own, "name", entities.name_index(registry(spark, sf_dir)))


def unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = read(spark, sf_dir, "nation").select(F.concat(F.lit("p"), (F.col("n_nationkey") % 9).cast("string")).alias("page"), F.when(F.col("n_nationkey") % 4 == 0, F.concat("n_name", F.lit(" B"))).otherwise(F.col("n_name")).alias("name"), F.col("n_name").alias("entity"))
    return entities.unused_aliases(aliases, written(spark, sf_dir))


def contradictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg = registry(spark, sf_dir)
    links = written(spark, sf_dir).where("name <> '' and article <> ''").select("page", F.concat(F.col("name"), F.lit(" ( )")).alias("visible"), "article", "name")
    with_paren = reg.withColumn("aliases", F.transform(F.concat(F.array("entity"), "aliases"), lambda a: F.concat(a, F.lit(" ( )")))).withColumn("aliases", F.concat(F.array("entity"), "aliases"))
    names, arts = entities.name_index(with_paren), entities.article_index(articles(spark, sf_dir), reg)
    return entities.contradictory_links(links, names, arts)


KEY = ["page", "matchday", "home", "away", "hs", "aws"]


def amendments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One for some matches, and as many again that fit no match."""
    some = matches(spark, sf_dir).where("row_id rlike '^[0-9]*7-[1-3]-[0-9]*3-' and hs is not null")
    real = some.select(F.concat(F.lit("a"), "row_id").alias("amendment"), *KEY, "section")
    stray = some.select(F.concat(F.lit("s"), "row_id").alias("amendment"), "page", "matchday", F.lit("Nobody").alias("home"), *KEY[3:], "section")
    return real.union(stray)


def updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = amendments(spark, sf_dir).withColumn("to_home", F.col("away")).withColumn("to_away", F.col("home")).withColumn("to_venue", F.lit("moved"))
    rows, _ = amend.update(matches(spark, sf_dir), a, KEY, ["home", "away", "venue"], "swap")
    return rows.select("row_id", "home", "away", "venue")


def rescored(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = amendments(spark, sf_dir).withColumn("to_hs", F.when(F.col("hs") != 3, F.col("aws") + F.col("hs") % 2)).withColumn("to_aws", F.col("aws"))
    a = a.withColumn("to_hpens", F.when(F.col("hs") == 4, F.lit(9))).withColumn("to_apens", F.when(F.col("hs") == 4, F.lit(8)))
    rows, _ = amend.rescore(matches(spark, sf_dir), a, KEY)
    return rows.select("row_id", "hs", "aws", "hpens", "apens")


def deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, bad = amend.delete(matches(spark, sf_dir), amendments(spark, sf_dir), ["page", "home", "away", "hs", "aws"])
    return rows.groupBy("page").agg(F.count("*").alias("n")).union(bad.groupBy("step").agg(F.count("*").alias("n")))


def inserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = amendments(spark, sf_dir).withColumn("matchday", F.when(F.col("hs") == 2, "Fecha 99").otherwise(F.col("matchday"))).where("amendment like 's%' or hs = 1")
    blank = {c: F.lit(None).cast("int") for c in ("hpens", "apens")} | {"status": F.lit("")}
    rows, bad = amend.insert(matches(spark, sf_dir), a.drop("section"), ["page", "matchday", "home", "away"], ["home", "away", "hs", "aws"], ["page", "matchday"], blank)
    new = rows.where("row_id like '+%'").select("row_id", "page", "matchday", "home", "away", "hs", "aws", "hpens", "section", "venue")
    told = bad.select(F.col("amendment").alias("row_id"), *(F.lit(None).cast(t).alias(c) for c, t in new.dtypes[1:]))
    return new.union(told)


def renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = matches(spark, sf_dir).select("page").distinct().where("page < 'B'").select("page", F.explode(F.array(F.lit("Club 4"), F.lit("Club 5"))).alias("name"))
    rows, _ = amend.rename(matches(spark, sf_dir), aliases.withColumn("to_name", F.concat("name", F.lit(" (Norte)"))))
    return rows.select("row_id", "home", "away")


QUERIES = {
    "vote_mapping": voting,
    "second_source_names": lambda s, d: resolved_external(s, d).select("page", "date", "matchday", "home_id", "away_id", "home_club", "away_club"),
    "unique_key_fill": filled,
    "out_of_season_dates": out_of_season,
    "nearest_by_date": repeats,
    "shared_venue_pairs": venues,
    "span_anti_join": spans,
    "one_sided_names": lambda s, d: joins.one_sided(written(s, d).withColumn("name", F.when(F.substring_index("name", "_", -1).try_cast("int") >= 20, "nobody").otherwise(F.col("name"))), registry(s, d).withColumnRenamed("entity", "name"), "name"),
    "entity_resolution": resolution,
    "canonical_names": canonical,
    "sure_names": sure_names,
    "unused_aliases": unused,
    "contradictory_links": contradictions,
    "amend_update": updated,
    "amend_score": rescored,
    "amend_delete": deleted,
    "amend_insert": inserted,
    "amend_rename": renamed,
    "amend_unmatched": lambda s, d: amend.cardinality(matches(s, d), amendments(s, d), KEY).where("matched <> 1").select("amendment", "matched"),
    "waiver_orphans": lambda s, d: amend.orphans(amendments(s, d).select("amendment", "page", "home", "away"), matches(s, d).where("hs = aws"), ["page", "home", "away"]),
}

_VOTING = f"m AS ({sql(finer(MATCH))}), x AS ({sql(finer(EXTERNAL))})"
_DAY = "coalesce(try_cast(regexp_extract(matchday, '(\\d+)', 1) AS INT), 0)"
_NAMED = f"""{X}, nx AS (SELECT page, date, matchday, home, away, home_id, away_id, hs, aws, section,
  CASE WHEN CAST(substr(home_id, 2) AS INT) < 10 OR (home <> '' AND home <> 'Club 15') THEN CASE WHEN CAST(substr(home_id, 2) AS INT) < 10 THEN 'Club ' || substr(home_id, 2) ELSE home END END AS home_club,
  CASE WHEN away <> 'Club 15' THEN away END AS away_club FROM x)"""
_NORM = "trim(regexp_replace(replace(lower(strip_accents({0})), '.', ' '), '\\s+', ' ', 'g'))"
_WRITTEN = """w AS (SELECT c_custkey, concat('p', c_custkey % 9) AS page,
  CASE c_custkey % 5 WHEN 0 THEN concat('NATION_', c_nationkey) WHEN 1 THEN concat('  ñacion   ', c_nationkey) WHEN 2 THEN concat('n ', c_nationkey) WHEN 3 THEN 'nobody' ELSE '' END AS name,
  CASE WHEN c_custkey % 7 < 3 THEN concat('ARTICULO ', c_custkey % 27) ELSE '' END AS article FROM customer)"""
_NAMES = f"al AS (SELECT n_name AS entity, {_NORM.format('unnest([n_name, concat(chr(209), $$ación $$, n_nationkey), concat($$N. $$, n_nationkey)])')} AS nm FROM nation)"
_ARTS = f"ar AS (SELECT {_NORM.format('concat($$Artículo $$, n_nationkey)')} AS art, n_name AS entity FROM nation WHERE n_nationkey < 20)"
_SOME = "regexp_matches(row_id, '^[0-9]*7-[1-3]-[0-9]*3-') AND hs IS NOT NULL"
_AMEND = f"""{M}, a AS (SELECT 'a' || row_id AS amendment, page, matchday, home, away, hs, aws, section FROM m WHERE {_SOME} UNION ALL SELECT 's' || row_id, page, matchday, 'Nobody', away, hs, aws, section FROM m WHERE {_SOME}),
n AS (SELECT page, matchday, home, away, hs, aws, count(*) AS n FROM m GROUP BY ALL), one AS (SELECT a.* FROM a JOIN n USING (page, matchday, home, away, hs, aws) WHERE n.n = 1)"""
_UNORDERED = "least(home, away) AS lo, greatest(home, away) AS hi"

ORACLE_SQL = {
    "vote_mapping": f"""WITH {_VOTING}, om AS (SELECT page, {_DAY} AS day, hs, aws, min(home) AS home, min(away) AS away FROM m GROUP BY ALL HAVING count(*) = 1),
ox AS (SELECT page, matchday AS day, hs, aws, min(home_id) AS hid, min(away_id) AS aid FROM x GROUP BY ALL HAVING count(*) = 1),
v AS (SELECT page, hid AS ext_id, home AS club FROM om JOIN ox USING (page, day, hs, aws) UNION ALL SELECT page, aid, away FROM om JOIN ox USING (page, day, hs, aws)),
c AS (SELECT page, ext_id, club, count(*) AS votes FROM v GROUP BY ALL), t AS (SELECT *, (sum(votes) OVER (PARTITION BY page, ext_id))::BIGINT - votes AS against FROM c),
b AS (SELECT *, CASE WHEN votes < 2 THEN 'weak' WHEN against * 4 > votes THEN 'disputed' WHEN against > 0 THEN 'minority' ELSE 'accepted' END AS verdict FROM t QUALIFY row_number() OVER (PARTITION BY page, ext_id ORDER BY votes DESC, club) = 1)
SELECT page, ext_id, club, votes, against, verdict, verdict IN ('accepted', 'minority') AND count(*) FILTER (verdict IN ('accepted', 'minority')) OVER (PARTITION BY page, club) > 1 AS clash FROM b""",
    "second_source_names": f"WITH {_NAMED} SELECT page, date, matchday, home_id, away_id, home_club, away_club FROM nx",
    "unique_key_fill": f"""WITH {M}, {_NAMED}, k AS (SELECT page, section, matchday AS day, home_club AS home, away_club AS away, min(date) AS x_date, min(hs) AS x_hs, min(aws) AS x_aws FROM nx WHERE home_club IS NOT NULL AND away_club IS NOT NULL GROUP BY ALL HAVING count(*) = 1),
st AS (SELECT DISTINCT page, matchday, home, away, true AS settled FROM m WHERE home = 'Club 7' AND season = 1998),
j AS (SELECT m.*, x_date, settled, m.hs IS NOT DISTINCT FROM x_hs AND m.aws IS NOT DISTINCT FROM x_aws AS same FROM (SELECT *, {_DAY} AS day FROM m WHERE date = '') m LEFT JOIN k USING (page, section, day, home, away) LEFT JOIN st USING (page, matchday, home, away)),
f AS (SELECT *, CASE WHEN x_date IS NULL THEN 'unmatched' WHEN same THEN 'filled' WHEN settled THEN 'arbitrated' ELSE 'score_differs' END AS fill FROM j)
SELECT page, row_id, CASE WHEN fill IN ('filled', 'arbitrated') THEN x_date ELSE '' END AS date, CASE WHEN fill IN ('filled', 'arbitrated') THEN 'second' ELSE '' END AS date_credit, fill FROM f""",
    "out_of_season_dates": f"""WITH {M}, j AS (SELECT page, row_id, season, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CASE WHEN hs < 4 THEN 'second' ELSE '' END AS date_credit FROM m JOIN orders ON o_orderkey = CAST(split_part(row_id, '-', 1) AS BIGINT)),
c AS (SELECT *, date_credit <> '' AND NOT CAST(substr(date, 1, 4) AS INT) IN (season, CASE WHEN season = 1997 THEN 1996 ELSE season END) AS cleared FROM j)
SELECT page, row_id, CASE WHEN cleared THEN '' ELSE date END AS date, CASE WHEN cleared THEN '' ELSE date_credit END AS date_credit, cleared FROM c""",
    "nearest_by_date": f"""WITH {M}, t AS (SELECT page, row_id, CAST(CAST(date AS DATE) + CASE WHEN hs >= 3 THEN hs ELSE 0 END AS VARCHAR) AS date, away AS home, home AS away, {_UNORDERED} FROM m WHERE date <> '' AND phase = 'knockout' AND matchday IN ('Final', 'Cuartos')),
o AS (SELECT *, {_UNORDERED} FROM m WHERE date <> '' AND (matchday <> 'Cuartos' OR aws <> 2)), seen AS (SELECT DISTINCT page, lo, hi, date, true AS seen FROM o),
near AS (SELECT t.row_id, o.row_id AS near_row, o.date AS near_date FROM t JOIN o USING (page, lo, hi) WHERE o.phase = 'knockout' QUALIFY row_number() OVER (PARTITION BY t.row_id ORDER BY abs(date_diff('day', CAST(o.date AS DATE), CAST(t.date AS DATE))), o.row_id) = 1)
SELECT page, row_id, date, home, away, CASE WHEN seen THEN 'repeated' WHEN near_row IS NOT NULL THEN 'conflict' ELSE 'new' END AS verdict, CASE WHEN seen IS NULL THEN near_row END AS near_row, CASE WHEN seen IS NULL THEN near_date END AS near_date
FROM t LEFT JOIN seen USING (page, lo, hi, date) LEFT JOIN near USING (row_id)""",
    "shared_venue_pairs": """WITH p AS (SELECT p_brand AS venue, CASE WHEN p_size % 3 = 0 THEN split_part(p_name, ' ', 1) WHEN p_size % 3 = 1 THEN concat(p_name, ' (', p_type, ')') ELSE p_name END AS club FROM part WHERE p_size <= 45),
h AS (SELECT venue, club, count(*) AS n, regexp_replace(club, ' \\(.*', '') AS core FROM p WHERE (venue, club) NOT IN (('Brand#2', 'red widget'), ('Brand#17', 'blue')) GROUP BY ALL)
SELECT a.venue, a.club AS one, b.club AS two, a.n AS n_one, b.n AS n_two FROM h a JOIN h b ON a.venue = b.venue AND a.club < b.club
WHERE a.core = b.core OR starts_with(a.core, b.core || ' ') OR ends_with(a.core, ' ' || b.core) OR starts_with(b.core, a.core || ' ') OR ends_with(b.core, ' ' || a.core)""",
    "span_anti_join": """WITH e AS (SELECT concat('u', user_id % 10) AS page, event_id AS pos, event_type FROM events), s AS (SELECT page, pos AS a, pos + (pos % 7) * 5 AS b FROM e WHERE event_type = 'error')
SELECT page, pos, event_type FROM e WHERE event_type <> 'error' AND NOT EXISTS (FROM s WHERE s.page = e.page AND a <= pos AND pos < b)""",
    "one_sided_names": f"WITH {_WRITTEN} SELECT n_name AS name FROM nation EXCEPT SELECT name FROM w JOIN customer USING (c_custkey) WHERE c_nationkey < 20",
    "entity_resolution": f"WITH {_WRITTEN}, {_NAMES}, {_ARTS} SELECT c_custkey, coalesce(ar.entity, al.entity) AS entity FROM w LEFT JOIN al ON nm = {_NORM.format('w.name')} LEFT JOIN ar ON art = {_NORM.format('w.article')}",
    "canonical_names": f"""WITH {_WRITTEN}, {_NAMES}, c AS (SELECT c_custkey, page, coalesce(entity, name) AS name FROM w LEFT JOIN al ON nm = {_NORM.format('w.name')})
SELECT c_custkey, page, CASE WHEN page = 'p0' AND name = 'NATION_3' THEN 'NATION_3 (p0)' WHEN page = 'p1' AND name = 'nobody' THEN 'somebody' ELSE name END AS name FROM c""",
    "sure_names": f"WITH {_WRITTEN} SELECT w.c_custkey, n_name AS name FROM w JOIN customer USING (c_custkey) JOIN nation ON c_nationkey = n_nationkey WHERE name NOT IN ('', 'nobody')",
    "unused_aliases": f"""WITH {_WRITTEN}, al AS (SELECT concat('p', n_nationkey % 9) AS page, CASE WHEN n_nationkey % 4 = 0 THEN n_name || ' B' ELSE n_name END AS name, n_name AS entity FROM nation)
SELECT page, name, entity FROM al WHERE (page, name) NOT IN (SELECT (page, name) FROM w)""",
    "contradictory_links": f"""WITH {_WRITTEN}, {_NAMES}, {_ARTS} SELECT DISTINCT page, article, name || ' ( )' AS visible, al.entity AS by_name, ar.entity AS by_article FROM w JOIN al ON nm = {_NORM.format('w.name')} JOIN ar ON art = {_NORM.format('w.article')}
WHERE name <> '' AND article <> '' AND al.entity <> ar.entity""",
    "amend_update": f"WITH {_AMEND} SELECT m.row_id, CASE WHEN o.page IS NULL THEN m.home ELSE m.away END AS home, CASE WHEN o.page IS NULL THEN m.away ELSE m.home END AS away, CASE WHEN o.page IS NULL THEN m.venue ELSE 'moved' END AS venue FROM m LEFT JOIN (SELECT DISTINCT page, matchday, home, away, hs, aws FROM one) o USING (page, matchday, home, away, hs, aws)",
    "amend_score": f"""WITH {_AMEND}, t AS (SELECT DISTINCT page, matchday, home, away, hs, aws, aws + hs % 2 AS t_hs, CASE WHEN hs = 4 THEN 9 END AS t_hp, CASE WHEN hs = 4 THEN 8 END AS t_ap FROM one WHERE hs <> 3)
SELECT m.row_id, coalesce(t_hs, m.hs) AS hs, m.aws AS aws, CASE WHEN t_hs IS NULL THEN hpens ELSE coalesce(t_hp, CASE WHEN t_hs = m.aws THEN hpens END) END AS hpens, CASE WHEN t_hs IS NULL THEN apens ELSE coalesce(t_ap, CASE WHEN t_hs = m.aws THEN apens END) END AS apens
FROM m LEFT JOIN t USING (page, matchday, home, away, hs, aws)""",
    "amend_delete": f"""WITH {_AMEND} SELECT page, count(*) AS n FROM m WHERE NOT EXISTS (FROM a WHERE m.page = a.page AND m.home = a.home AND m.away = a.away AND m.hs IS NOT DISTINCT FROM a.hs AND m.aws = a.aws) GROUP BY page
UNION ALL SELECT 'delete', count(*) FROM a WHERE NOT EXISTS (FROM m WHERE m.page = a.page AND m.home = a.home AND m.away = a.away AND m.hs = a.hs AND m.aws = a.aws)""",
    "amend_insert": f"""WITH {_AMEND}, b AS (SELECT amendment, page, CASE WHEN hs = 2 THEN 'Fecha 99' ELSE matchday END AS matchday, home, away, hs, aws FROM a WHERE starts_with(amendment, 's') OR hs = 1),
sib AS (SELECT page, matchday, section, venue FROM m QUALIFY row_number() OVER (PARTITION BY page, matchday ORDER BY row_id) = 1),
c AS (SELECT b.*, EXISTS (FROM m WHERE m.page = b.page AND m.matchday = b.matchday AND m.home = b.home AND m.away = b.away) AS there, sib.page IS NULL AS lone, section, venue FROM b LEFT JOIN sib USING (page, matchday))
SELECT '+' || amendment AS row_id, page, matchday, home, away, hs, aws, NULL::INT AS hpens, section, venue FROM c WHERE NOT there AND NOT lone
UNION ALL SELECT amendment, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM c WHERE there OR lone""",
    "amend_rename": f"WITH {M} SELECT row_id, CASE WHEN page < 'B' AND home IN ('Club 4', 'Club 5') THEN home || ' (Norte)' ELSE home END AS home, CASE WHEN page < 'B' AND away IN ('Club 4', 'Club 5') THEN away || ' (Norte)' ELSE away END AS away FROM m",
    "amend_unmatched": f"WITH {_AMEND} SELECT amendment, coalesce(n.n, 0) AS matched FROM a LEFT JOIN n USING (page, matchday, home, away, hs, aws) WHERE coalesce(n.n, 0) <> 1",
    "waiver_orphans": f"WITH {_AMEND} SELECT amendment, page, home, away FROM a WHERE NOT EXISTS (FROM m WHERE m.page = a.page AND m.home = a.home AND m.away = a.away AND m.hs = m.aws)",
}
