"""Queries of text and date functions, labels and outlines, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchledger.functions import dates, text
from matchledger.functions.letters import unescaped
from matchledger.operators import entities, relational
from matchledger.plans.views import M, matches, read

MESSY = "concat('<ref name=x>n', CAST(p_partkey AS STRING), '</ref>[[Club ', p_name, '|', p_name, ']] ''''''', p_brand, ''''''' {{flag|', p_type, '}}<sup>', CAST(p_size AS STRING), '</sup> <b>(', CAST(p_size % 3 AS STRING), ')</b>   ', CASE WHEN p_size % 4 = 0 THEN '{{nowrap|kept}} (*)' WHEN p_size % 4 = 1 THEN 'x¹²' ELSE '[[Archivo:a.png]]' END)"
SCORE = "CASE l_linenumber WHEN 1 THEN concat(CAST(l_suppkey AS STRING), ' - ', CAST(l_partkey AS STRING)) WHEN 2 THEN concat('(', CAST(l_suppkey AS STRING), ') ', CAST(l_partkey AS STRING), ':', CAST(l_linenumber AS STRING)) WHEN 3 THEN concat('  ', CAST(l_suppkey AS STRING), '–', CAST(l_partkey AS STRING), ' (3)') WHEN 4 THEN 'Fecha sin numero' ELSE concat('Fecha ', CAST(l_suppkey AS STRING), ' - ', CAST(l_partkey AS STRING)) END"
NOTE = "CASE o_orderkey % 7 WHEN 0 THEN 'El partido fue SUSPENDIDO y se jugó el 3 de mayo' WHEN 1 THEN 'Abandonó el campo' WHEN 2 THEN 'se le dio por ganado' WHEN 3 THEN 'mala inclusión' WHEN 4 THEN 'el tribunal decide' WHEN 5 THEN 'no se presentó; se le dio por perdido' ELSE 'nada' END"
DAY = "concat(CASE WHEN o_orderkey % 9 = 0 THEN 'jugado el ' ELSE '' END, CAST(day(o_orderdate) AS STRING), ' de ', CASE month(o_orderdate) WHEN 1 THEN 'enero' WHEN 2 THEN 'Febrero' WHEN 3 THEN 'marzo' WHEN 4 THEN 'abril' WHEN 5 THEN 'mayo' WHEN 6 THEN 'junio' WHEN 7 THEN 'JULIO' WHEN 8 THEN 'agosto' WHEN 9 THEN 'setiembre' WHEN 10 THEN 'octubre' WHEN 11 THEN 'brumario' ELSE 'diciembre' END, CASE WHEN o_orderkey % 4 = 0 THEN concat(' de ', CAST(year(o_orderdate) AS STRING)) ELSE '' END)"


def dealt(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table in as many parts as the session's shuffles have: a million short rows may be one small file, which is one task."""
    return read(spark, sf_dir, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def season_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{DAY} AS told", "1996 AS first", "CASE WHEN o_orderkey % 3 <> 0 THEN 1997 END AS last")
    return own.select("o_orderkey", dates.iso_date(F.col("told"), F.col("first"), F.col("last")).alias("date"))


def played(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS o_orderkey", "CAST(CAST(l_shipdate AS DATE) AS STRING) AS shipped")
    both = line.join(read(spark, sf_dir, "orders").selectExpr("o_orderkey", "CAST(CAST(o_orderdate AS DATE) AS STRING) AS ordered"), "o_orderkey")
    return both.select("o_orderkey", "shipped", dates.not_before(F.col("shipped"), F.col("ordered")).alias("date"))


def local_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", dates.local_date(F.col("ts").cast("string"), F.col("user_id") >= 0).alias("local_date"))


def headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit(r"(?s)<h([1-6])[^>]*>(.*?)</h"), 1)
    titles = F.regexp_extract_all("html", F.lit(r"(?s)<h([1-6])[^>]*>(.*?)</h"), 2)
    each = read(spark, sf_dir, "pages").select("page_id", F.posexplode(F.arrays_zip(found.alias("level"), titles.alias("title"))).alias("seq", "h"))
    return each.select("page_id", "seq", F.col("h.level").cast("int").alias("level"), F.trim(F.regexp_replace("h.title", "<[^>]+>", "")).alias("title"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = '<a href="([^"]+)">([^<]+)</a>'
    zipped = F.arrays_zip(F.regexp_extract_all("html", F.lit(pattern), 1).alias("a"), F.regexp_extract_all("html", F.lit(pattern), 2).alias("v"))
    # a visible name leads to the page's own path in some pages, so that it is not unique there
    each = read(spark, sf_dir, "pages").select(F.col("page_id").alias("page"), F.explode(zipped).alias("x"))
    own = each.select("page", F.when((F.col("page") % 3 == 0) & F.col("x.a").contains("t"), F.lower(F.concat("x.a", F.lit("-")))).otherwise(F.col("x.a")).alias("article"), F.col("x.v").alias("visible"))
    return entities.page_articles(own)


def asof_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", relational.asof(ev, ["user_id"], ["event_id"], F.when(F.col("event_type") == "signup", F.col("event_id"))).alias("signup"))


def bounded_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    begins = F.when(F.col("event_type") == "signup", F.col("event_id"))
    return ev.select("event_id", "user_id", relational.carried(["user_id"], ["event_id"], begins, (F.col("event_id") % 4) + 1).alias("held"))


def last_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", "role", F.length(relational.asof(conv, ["conv_id"], ["turn"], F.when(F.col("role") == "user", F.col("text")))).alias("question_chars"))


def winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return matches(spark, sf_dir).select("row_id", text.winner(c("home"), c("away"), c("hs"), c("aws"), c("hpens"), c("apens")).alias("won"), text.round_name(c("matchday")).alias("round"), text.round_rank(text.round_name(c("matchday"))).alias("rung"))


def top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.top1(read(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], F.desc("c_acctbal"), "c_custkey").select("c_nationkey", "c_mktsegment", "c_custkey")


def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read(spark, sf_dir, "customer").selectExpr("CASE WHEN c_custkey % 2 = 0 THEN c_nationkey ELSE c_nationkey + 9 END AS k")
    b = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    part = lambda df, name: df.distinct().select(F.lit(name).alias("op"), "k")
    return part(a.union(b), "union").union(part(a.intersect(b), "intersect")).union(part(a.subtract(b), "except")).union(part(b.subtract(a), "reverse"))


def set_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each customer's nation: do its suppliers' balances' signs cover the set, and are the sets equal?"""
    c = read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.collect_set(F.floor(F.col("c_acctbal") / 2000).cast("int")).alias("a"))
    s = read(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.collect_set(F.floor(F.col("s_acctbal") / 2000).cast("int")).alias("b"))
    both = c.join(s, "k", "full_outer").select("k", F.coalesce("a", F.array().cast("array<int>")).alias("a"), F.coalesce("b", F.array().cast("array<int>")).alias("b"))
    covers = F.size(F.array_except("b", "a")) == 0
    return both.select("k", covers.alias("covers"), (covers & (F.size(F.array_except("a", "b")) == 0)).alias("equal"))


def first_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("page").orderBy("row_id")
    return matches(spark, sf_dir).withColumn("k", F.row_number().over(w)).where("k <= 6").select("page", "k", "row_id")


#: Names with letters of many languages, some of which have no base letter.
LETTERS = "concat(substring('šžőğąęćńśźčěřůțșāēīūķļØłßŠŽŐĞÀÉ', CAST(p_partkey % 31 AS INT) + 1, 3), 'Ş ', p_name, '’', substring('ďťňľĺŕéíóúýäôçãõñåöüâêî', CAST(p_size % 23 AS INT) + 1, 2), ' ( ', p_brand, ' ).')"
#: Wrappers of three levels, one of them never closed.
NESTED = "concat('{{nowrap|{{flag|{{x|', p_brand, '}}}} ', p_name, ' {{ nowrap | ', p_type, '}} {{y|z}}}}', CASE WHEN p_size % 3 = 0 THEN ' {{nowrap|open {{nowrap|in}} end' ELSE '' END)"
ENTITIES = "concat('&#', CAST(161 + p_partkey % 700 AS STRING), ';', p_name, '&eacute;&amp;lt;&copy ', '&#x', {0}, ';&unknown; & &ntilde', p_brand)"


QUERIES = {
    "letters": lambda s, d: dealt(s, d, "part").selectExpr("p_partkey", f"{LETTERS} AS n").select("p_partkey", text.normalized(F.col("n")).alias("name")),
    "nested_wrappers": lambda s, d: dealt(s, d, "part").selectExpr("p_partkey", f"{NESTED} AS n").select("p_partkey", text.clean(F.col("n")).alias("clean")),
    "entities": lambda s, d: dealt(s, d, "part").selectExpr("p_partkey", ENTITIES.format("lower(hex(161 + p_size))") + " AS n").select("p_partkey", unescaped(F.col("n")).alias("told")),
    "clean_text": lambda s, d: dealt(s, d, "part").selectExpr("p_partkey", f"{MESSY} AS raw").select("p_partkey", text.clean(F.col("raw")).alias("clean")),
    "normalize_name": lambda s, d: read(s, d, "documents").select("doc_id", F.md5(text.normalized(F.col("text"))).alias("name_md5")),
    "core_name": lambda s, d: dealt(s, d, "part").selectExpr("p_partkey", "concat('Ñandú ', p_name, '. (', p_type, ') ', p_brand) AS n").select("p_partkey", text.core_name(F.col("n")).alias("core"), text.base_name(F.concat("n", F.lit(" (x)"))).alias("base")),
    "score_parse": lambda s, d: read(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{SCORE} AS told").select("l_orderkey", "l_linenumber", text.score(F.col("told"))["home"].alias("hs"), text.score(F.col("told"))["away"].alias("aws"), text.label_number(F.col("told")).alias("number")),
    "status_case": lambda s, d: read(s, d, "orders").selectExpr("o_orderkey", f"{NOTE} AS note").select("o_orderkey", text.status(F.col("note")).alias("status"), text.unread_ruling(F.col("note")).alias("unread")),
    "season_year_rule": season_dates,
    "played_date_override": played,
    "local_date_tz": local_dates,
    "heading_outline": headings,
    "link_map_unique": page_links,
    "asof_label": asof_label,
    "bounded_carry": bounded_carry,
    "conversation_forward_fill": last_question,
    "winner_and_round": winners,
    "top1": top_rows,
    "ordered_distinct": lambda s, d: relational.ordered_distinct(read(s, d, "orders"), ["o_custkey", "o_orderpriority"], "o_orderkey"),
    "only_unique_keys": lambda s, d: relational.only(read(s, d, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"]),
    "set_ops": set_operations,
    "set_tests": set_tests,
    "first_samples": first_samples,
}

#: What normalized() does, for letters with accents and apostrophes.
_NORMALIZED = r"""trim(regexp_replace(regexp_replace(regexp_replace(replace(lower(regexp_replace(strip_accents(translate({0}, '`’´', '''''''')), '[^\x00-\x7F]', '', 'g')), '.', ' '), '\s*\(\s*', ' (', 'g'), '\s*\)', ')', 'g'), '\s+', ' ', 'g'), ' ')"""
_MONTH = "CASE month(o_orderdate) WHEN 11 THEN NULL ELSE month(o_orderdate) END"
_UNFINISHED = "regexp_matches(note, '(?i)suspendid|abandon[oó]|no se present[oó]|interrumpi')"
_DESK = "regexp_matches(note, '(?i)se le dio por (ganado|perdido)|(mala|indebida) inclusi[oó]n')"

ORACLE_SQL = {
    "letters": f"SELECT p_partkey, {_NORMALIZED.format(LETTERS)} AS name FROM part",
    "nested_wrappers": """SELECT p_partkey, concat('{{flag|}} ', p_name, ' ', p_type, CASE WHEN p_size % 3 = 0 THEN ' open in}} end' ELSE '' END) AS clean FROM part""",
    "entities": """SELECT p_partkey, concat(chr((161 + p_partkey % 700)::INT), p_name, 'é&lt;© ', chr((161 + p_size)::INT), '&unknown; & ñ', p_brand) AS told FROM part""",
    "clean_text": """SELECT p_partkey, concat(p_name, ' ', p_brand, ' (', p_size % 3, ')', CASE p_size % 4 WHEN 0 THEN ' kept' WHEN 1 THEN ' x' ELSE '' END) AS clean FROM part""",
    "normalize_name": f"SELECT doc_id, md5({_NORMALIZED.format('text')}) AS name_md5 FROM documents",
    "core_name": """SELECT p_partkey, concat('nandu ', p_name, ' ', regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g')) AS core, concat('nandu ', p_name, ' (', lower(p_type), ') ', lower(p_brand)) AS base FROM part""",
    "score_parse": """SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN l_suppkey WHEN 2 THEN l_partkey WHEN 3 THEN l_suppkey END::INT AS hs, CASE l_linenumber WHEN 1 THEN l_partkey WHEN 2 THEN l_linenumber WHEN 3 THEN l_partkey END::INT AS aws,
  CASE WHEN l_linenumber = 4 THEN 0 ELSE l_suppkey END::INT AS number FROM lineitem""",
    "status_case": f"""WITH n AS (SELECT o_orderkey, {NOTE} AS note FROM orders), s AS (SELECT *, CASE WHEN contains(note, 'se jugó el 3') THEN '' WHEN {_UNFINISHED} THEN 'suspended' WHEN {_DESK} THEN 'desk' ELSE '' END AS status FROM n)
SELECT o_orderkey, status, note = 'el tribunal decide' AS unread FROM s""",
    "season_year_rule": f"""SELECT o_orderkey, CASE WHEN month(o_orderdate) = 11 THEN '' ELSE printf('%d-%02d-%02d', CASE WHEN o_orderkey % 4 = 0 THEN year(o_orderdate) WHEN o_orderkey % 3 = 0 OR month(o_orderdate) >= 8 THEN 1996 ELSE 1997 END, {_MONTH}, day(o_orderdate)) END AS date FROM orders""",
    "played_date_override": """SELECT o_orderkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped, CASE WHEN CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE) THEN concat(year(l_shipdate) + 1, strftime(l_shipdate, '-%m-%d')) ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS date FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "local_date_tz": "SELECT event_id, CAST(CAST(ts - INTERVAL 3 HOUR AS DATE) AS VARCHAR) AS local_date FROM events",
    "heading_outline": """WITH h AS (SELECT page_id, regexp_extract_all(html, '(?s)<h([1-6])[^>]*>(.*?)</h', 1) AS l, regexp_extract_all(html, '(?s)<h([1-6])[^>]*>(.*?)</h', 2) AS t FROM pages), e AS (SELECT page_id, l, t, unnest(range(len(l))) AS seq FROM h)
SELECT page_id, seq::INT AS seq, l[seq + 1]::INT AS level, trim(regexp_replace(t[seq + 1], '<[^>]+>', '', 'g'), ' ') AS title FROM e""",
    "link_map_unique": """WITH h AS (SELECT page_id AS page, regexp_extract_all(html, '<a href="([^"]+)">([^<]+)</a>', 1) AS a, regexp_extract_all(html, '<a href="([^"]+)">([^<]+)</a>', 2) AS v FROM pages), e AS (SELECT page, unnest(a) AS a, unnest(v) AS v FROM h),
l AS (SELECT page, CASE WHEN page % 3 = 0 AND contains(a, 't') THEN lower(a || '-') ELSE a END AS article, v AS visible FROM e)
SELECT page, visible, min(article) AS article FROM l GROUP BY page, visible HAVING count(DISTINCT """ + _NORMALIZED.format("article") + ") = 1",
    "asof_label": "SELECT event_id, user_id, max(CASE WHEN event_type = 'signup' THEN event_id END) OVER (PARTITION BY user_id ORDER BY event_id) AS signup FROM events",
    "bounded_carry": """WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth FROM events), l AS (SELECT *, max(CASE WHEN event_type = 'signup' THEN nth END) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM n)
SELECT l.event_id, l.user_id, CASE WHEN l.nth < l.b + s.event_id % 4 + 1 THEN s.event_id END AS held FROM l LEFT JOIN n s ON s.user_id = l.user_id AND s.nth = l.b""",
    "conversation_forward_fill": "SELECT conv_id, turn, role, length(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)) AS question_chars FROM conversations",
    "winner_and_round": f"""WITH {M} SELECT row_id, CASE WHEN hs > aws THEN home WHEN aws > hs THEN away WHEN hpens IS NULL THEN '' WHEN hpens > apens THEN home ELSE away END AS won,
  CASE WHEN starts_with(matchday, 'Octavos') THEN 'octavos' WHEN matchday = 'Cuartos' THEN 'cuartos' WHEN starts_with(matchday, 'Semi') THEN 'semifinales' ELSE lower(matchday) END AS round,
  CASE WHEN starts_with(matchday, 'Octavos') THEN 11 WHEN matchday = 'Cuartos' THEN 12 WHEN starts_with(matchday, 'Semi') THEN 13 WHEN matchday = 'Final' THEN 14 END AS rung FROM m""",
    "top1": "SELECT c_nationkey, c_mktsegment, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal DESC, c_custkey) = 1",
    "ordered_distinct": "SELECT o_custkey, o_orderpriority, min(o_orderkey) AS first_at FROM orders GROUP BY ALL",
    "only_unique_keys": "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) = 1",
    "set_ops": """WITH a AS (SELECT DISTINCT CASE WHEN c_custkey % 2 = 0 THEN c_nationkey ELSE c_nationkey + 9 END AS k FROM customer), b AS (SELECT DISTINCT s_nationkey AS k FROM supplier)
SELECT 'union' AS op, k FROM (SELECT k FROM a UNION SELECT k FROM b) UNION ALL SELECT 'intersect', k FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT 'except', k FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'reverse', k FROM (SELECT k FROM b EXCEPT SELECT k FROM a)""",
    "set_tests": """WITH a AS (SELECT DISTINCT c_nationkey AS k, floor(c_acctbal / 2000) AS v FROM customer), b AS (SELECT DISTINCT s_nationkey AS k, floor(s_acctbal / 2000) AS v FROM supplier), k AS (SELECT k FROM a UNION SELECT k FROM b)
SELECT k, NOT EXISTS (FROM b WHERE b.k = k.k AND NOT EXISTS (FROM a WHERE a.k = b.k AND a.v = b.v)) AS covers,
  NOT EXISTS (FROM b WHERE b.k = k.k AND NOT EXISTS (FROM a WHERE a.k = b.k AND a.v = b.v)) AND NOT EXISTS (FROM a WHERE a.k = k.k AND NOT EXISTS (FROM b WHERE a.k = b.k AND a.v = b.v)) AS equal FROM k""",
    "first_samples": f"WITH {M} SELECT page, row_number() OVER (PARTITION BY page ORDER BY row_id)::INT AS k, row_id FROM m QUALIFY row_number() OVER (PARTITION BY page ORDER BY row_id) <= 6",
}
