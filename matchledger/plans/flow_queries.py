"""Queries of publishing, incremental reuse, second sources and outlines of extraction, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.operators import checks, joins
from matchledger.plans import build
from matchledger.plans.join_queries import ORACLE_SQL as JOIN_SQL
from matchledger.plans.join_queries import resolved_external
from matchledger.plans.views import MATCH, M, SIDES, matches, read, select
from matchledger.sinks import published as sink
from matchledger.sources import feeds, published, wikitext
from matchledger.streaming import refresh


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = matches(spark, sf_dir).select("page", "competition", "season").distinct()
    return pages.select("page", F.concat(F.lit("http://x/"), F.replace("page", F.lit(" "), F.lit("_"))).alias("url"), F.col("competition").alias("tournament"), "season", (F.col("season") == 1999).alias("neutral"), (F.col("season") < 1998).alias("closed"))


def credited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark, sf_dir).withColumn("date_credit", F.when(F.col("hs") == 2, "second").otherwise(""))


def shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    # as a table, so that Spark knows how small the catalogue is and moves no match to join it
    return sink.shaped(credited(spark, sf_dir), build.cut(catalog(spark, sf_dir), "catalog"))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated, undated = sink.routed(shaped(spark, sf_dir))
    count = lambda df, name: df.groupBy("season").agg(F.count("*").alias("n")).withColumn("part", F.lit(name))
    return count(dated, "dated").union(count(undated, "undated"))


def changed_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shaped(spark, sf_dir)
    return sink.changes(rescored(rows), rows.where("season <> 1996"))


def reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.reusable(shaped(spark, sf_dir), catalog(spark, sf_dir)).groupBy("tournament", "season").agg(F.count("*").alias("n"))


def json_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    club = lambda c: F.concat(F.lit("Club "), c.cast("string"))
    side = lambda where, name, score: F.struct(F.lit(where).alias("homeAway"), F.struct(name.alias("displayName")).alias("team"), score.cast("string").alias("score"))
    k = F.get_json_object("props", "$.k").cast("int")
    event = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm'Z'").alias("date"), F.array(F.struct(F.array(side("away", club(k % 20), F.when(k % 7 != 0, k % 5)), side("home", club(F.col("user_id") % 20), k % 4)).alias("competitors"))).alias("competitions"))
    feed = ev.select(F.col("event_id").cast("string").alias("page"), F.to_json(F.struct(F.array(event).alias("events"))).alias("text"))
    names = spark.range(15).select(F.concat(F.lit("Club "), F.col("id").cast("string")).alias("name")).withColumn("club", F.upper("name"))
    rows, _ = feeds.feed_matches(feed, names)
    return rows.select("page", "date", "home", "away", "hs", "aws")


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """League pages for each customer segment, nation and range of orders: a table of the orders, of which every fourth has no score. A page's length does not grow with the table."""
    own = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    score = F.when(F.col("o_orderkey") % 4 == 3, "-").otherwise(F.format_string("%d - %d", F.col("o_orderkey") % 5, F.col("o_custkey") % 4))
    row = F.concat_ws(" || ", F.concat(F.lit("| [[Club "), F.col("o_custkey") % 9, F.lit("|Team "), F.col("o_custkey") % 9, F.lit("]]")), score, F.concat(F.lit("'''Team "), F.col("o_orderkey") % 9, F.lit("'''")), "o_orderpriority", F.concat(F.dayofmonth("o_orderdate"), F.lit(" de mayo")), F.lit("16:00"))
    held = own.groupBy(F.concat_ws("-", "c_mktsegment", "c_nationkey", F.floor(F.col("o_orderkey") / 4000)).alias("page")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("row")))).alias("rows"))
    body = F.array_join(F.transform("rows", lambda r: F.concat(F.lit("|-\n"), r["row"])), "\n")
    return held.select("page", F.concat(F.lit('== Torneo ==\n=== Resultados ===\n{|\n! colspan="6" | Fecha 1\n|-\n! Local !! Resultado !! Visitante\n'), body, F.lit("\n|}\n")).alias("text"))


def extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = build.cut(wiki_pages(spark, sf_dir), "pages")
    about = pages.select("page", F.lit(1996).alias("first_year"), F.lit(None).cast("int").alias("last_year"), F.lit(8).alias("from_month"), F.lit("league").alias("layout"))
    got = wikitext.matches(pages, about, build.cut)
    return got.select("page", "date", "home", "away", "hs", "aws", "phase", "grp", "matchday", "section", "venue", "time")


def pipeline_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates filled and checked: the duplicates that remain by page."""
    got = joins.verified_fill(matches(spark, sf_dir), resolved_external(spark, sf_dir, fold=True), "second").drop("fill")
    return checks.duplicates(got).groupBy("page").agg(F.count("*").alias("n"))


def rescored(rows: DataFrame) -> DataFrame:
    """All seasons but one, and other scores in another."""
    return rows.where("season <> 1997").withColumn("away_score", F.when((F.col("season") == 2000) & (F.col("home_score") == 4), 9).otherwise(F.col("away_score")))


def published_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated rows published by season, and again after changes; what is read back from the files then."""
    rows = build.cut(sink.routed(shaped(spark, sf_dir))[0], "rows")
    at = build.folder(spark, "published")
    sink.write(spark, rows, at)
    sink.write(spark, rescored(rows), at)
    return published.read(spark, f"{at}/partition=*/*.csv")


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of all matches as a stream that ends, and the standings that it leaves."""
    source = spark.readStream.schema(read(spark, sf_dir, "lineitem").schema).parquet(f"{sf_dir}/lineitem.parque[t]")
    at_midnight = "timestamp_seconds(unix_date(CAST(l_shipdate AS DATE)) * 86400L) AS at"
    m = source.selectExpr(*select(MATCH), at_midnight)
    side = lambda club, gf, gc: F.struct(F.col(club).alias("club"), F.col(gf).alias("gf"), F.col(gc).alias("gc"))
    played = m.select("at", "season", F.inline(F.array(side("home", "hs", "aws"), side("away", "aws", "hs"))))
    out = build.folder(spark, "live")
    query = refresh.live_standings(played).writeStream.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{out}/rows"))
    query.option("checkpointLocation", f"{out}/stream").trigger(availableNow=True).start().awaitTermination()
    since = (F.unix_seconds(F.col("window.start")) / 86400).cast("int").alias("since")
    return spark.read.parquet(f"{out}/rows").select(since, "season", "club", "pj", "gf", "gc", "g", "e", "p")


BATCHES = 6


def in_batches(rows: DataFrame, at: str) -> int:
    """Writes rows in files of which a sixth is a batch, and tells how many that are. Each task deals its own rows, so none holds a batch."""
    rows.withColumn("dealt", F.pmod(F.xxhash64("row_id"), F.lit(BATCHES))).write.partitionBy("dealt").parquet(at)
    return -(-len(rows.sparkSession.read.parquet(at).inputFiles()) // BATCHES)


def stream_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches that come in six batches, rows of one key in any of them: duplicates, and clubs that play twice a matchday."""
    at = build.folder(spark, "batches")
    own = matches(spark, sf_dir)
    each = in_batches(own, f"{at}/in")
    files = lambda: spark.readStream.schema(own.schema).option("maxFilesPerTrigger", each).parquet(f"{at}/in")
    twice = ["page", "section", "grp", "matchday", "club"]
    asked = {
        "duplicate": (files().where("date <> ''"), ["page", "date", "home", "away"]),
        "twice_a_matchday": (checks.sides(files().where("phase = 'groups' and matchday <> ''"), *twice[1:4]), twice),
    }
    out = []
    for name, (rows, keys) in asked.items():
        refresh.repeated(rows, keys, f"{at}/{name}").awaitTermination()
        found = refresh.found_repeats(spark, keys, f"{at}/{name}")
        out.append(found.select(F.lit(name).alias("check"), "page", F.concat_ws("/", *keys[1:]).alias("key"), "n"))
    return out[0].union(out[1])


QUERIES = {
    "stream_repeats": stream_repeats,
    "publish_and_read": published_twice,
    "live_standings": live,
    "shape_for_publish": shaped,
    "route_dated": routed,
    "changed_seasons": changed_seasons,
    "incremental_reuse": reuse,
    "json_feed_unnest": json_feed,
    "wiki_extraction": extraction,
    "fill_then_check": pipeline_view,
}

_SHAPED = f"""{M}, s AS (SELECT date, time, home AS home_team, away AS away_team, hs AS home_score, aws AS away_score, hpens AS home_pens, apens AS away_pens, competition AS tournament, season, phase, grp AS "group", matchday, venue,
  coalesce(neutral, season = 1999) AS neutral, concat('http://x/', replace(page, ' ', '_'), CASE WHEN hs = 2 THEN ' + second' ELSE '' END) AS source, status FROM m)"""

_FILL, _FILLED = JOIN_SQL["unique_key_fill"].replace("season = 1998", "false").rsplit("\nSELECT", 1)  # nothing is settled here

ORACLE_SQL = {
    "stream_repeats": f"""WITH {SIDES} SELECT 'duplicate' AS "check", page, concat_ws('/', date, home, away) AS key, count(*) AS n FROM m WHERE date <> '' GROUP BY page, date, home, away HAVING count(*) > 1
UNION ALL SELECT 'twice_a_matchday', page, concat_ws('/', section, grp, matchday, club), count(*) FROM sides WHERE phase = 'groups' AND matchday <> '' GROUP BY page, section, grp, matchday, club HAVING count(*) > 1""",
    "fill_then_check": f"""{_FILL}, filled AS (SELECT{_FILLED}), got AS (SELECT page, coalesce(filled.date, m.date) AS date, home, away FROM m LEFT JOIN filled USING (page, row_id))
SELECT page, count(*) AS n FROM (SELECT page, date, home, away FROM got WHERE date <> '' GROUP BY ALL HAVING count(*) > 1) GROUP BY page""",
    "publish_and_read": f"WITH {_SHAPED} SELECT * REPLACE (CASE WHEN season = 2000 AND home_score = 4 THEN 9 ELSE away_score END AS away_score) FROM s WHERE trim(date) <> '' AND season <> 1997",
    "live_standings": f"""WITH {SIDES.replace("AS season", "AS season, CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) // 30 * 30 AS INT) AS since", 1)}
SELECT since, season, club, count(*) AS pj, sum(gf)::BIGINT AS gf, sum(gc)::BIGINT AS gc, count(*) FILTER (gf > gc) AS g, count(*) FILTER (gf = gc) AS e, count(*) FILTER (gf < gc) AS p FROM sides GROUP BY since, season, club""",
    "shape_for_publish": f"WITH {_SHAPED} SELECT * FROM s",
    "route_dated": f"WITH {_SHAPED} SELECT season, count(*) AS n, CASE WHEN date = '' THEN 'undated' ELSE 'dated' END AS part FROM s GROUP BY season, part",
    "changed_seasons": f"""WITH {_SHAPED}, n AS (SELECT season, count(*) AS n FROM s GROUP BY season)
SELECT season::VARCHAR AS season, CASE WHEN season = 1997 THEN 0 ELSE n END AS n FROM n WHERE season IN (1996, 1997, 2000)""",
    "incremental_reuse": f"WITH {_SHAPED} SELECT tournament, season, count(*) AS n FROM s WHERE season < 1998 GROUP BY ALL",
    "json_feed_unnest": """WITH e AS (SELECT event_id, ts, user_id % 20 AS h, (props->>'$.k')::INT AS k FROM events)
SELECT event_id::VARCHAR AS page, CAST(CAST(ts - INTERVAL 3 HOUR AS DATE) AS VARCHAR) AS date, concat('CLUB ', h) AS home, concat('CLUB ', k % 20) AS away, k % 4 AS hs, k % 5 AS aws FROM e WHERE h < 15 AND k % 20 < 15 AND k % 7 <> 0""",
    "wiki_extraction": """SELECT concat_ws('-', c_mktsegment, c_nationkey, (o_orderkey // 4000)) AS page, printf('1996-05-%02d', day(o_orderdate)) AS date, concat('Team ', o_custkey % 9) AS home, concat('Team ', o_orderkey % 9) AS away, (o_orderkey % 5)::INT AS hs, (o_custkey % 4)::INT AS aws,
  'groups' AS phase, 'Torneo' AS grp, 'Fecha 1' AS matchday, 'Torneo' AS section, o_orderpriority AS venue, '16:00' AS time FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 4 <> 3""",
}
