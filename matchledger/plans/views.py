"""The driver's tables seen as the tables of the library. The expressions read alike in Spark and in SQL, so each view is stated once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROW_ID = "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS STRING))"

#: lineitem as matches. A sixth of the orders are knockout rounds; some rows lack a date, a group or a score.
MATCH = {
    "page": "concat(l_returnflag, l_linestatus, ' ', CAST(year(l_shipdate) AS STRING))",
    "row_id": ROW_ID,
    "date": "CASE WHEN l_suppkey % 25 = 7 THEN '' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END",
    "time": "''",
    "home": "CASE WHEN l_suppkey % 100 = 41 THEN '' ELSE concat('Club ', CAST(l_suppkey % 20 AS STRING)) END",
    "away": "concat('Club ', CAST(l_partkey % 20 AS STRING))",
    "hs": "CASE WHEN l_suppkey % 50 = 3 AND l_linenumber = 1 THEN NULL WHEN l_quantity >= 50 THEN 50 ELSE CAST(CAST(floor(l_quantity) AS INT) % 6 AS INT) END",
    "aws": "CAST(CAST(floor(l_extendedprice) AS BIGINT) % 6 AS INT)",
    "hpens": "CASE WHEN l_orderkey % 9 = 0 THEN CAST(l_orderkey % 6 AS INT) END",
    "apens": "CASE WHEN l_orderkey % 9 = 0 THEN CAST(l_partkey % 5 AS INT) END",
    "competition": "concat(l_returnflag, l_linestatus)",
    "season": "CAST(year(l_shipdate) AS INT)",
    "phase": "CASE WHEN l_orderkey % 6 = 0 THEN 'knockout' ELSE 'groups' END",
    "grp": "CASE WHEN l_orderkey % 97 = 5 THEN '' WHEN l_orderkey % 11 = 3 THEN 'Interzonal' ELSE concat('Zona ', CAST(l_orderkey % 3 AS STRING)) END",
    "matchday": "CASE WHEN l_orderkey % 6 <> 0 THEN concat('Fecha ', CAST(l_linenumber * 2 AS STRING)) WHEN l_linenumber = 1 THEN 'Octavos de final' WHEN l_linenumber = 2 THEN 'Octavos' WHEN l_linenumber = 3 THEN 'Cuartos' WHEN l_linenumber = 4 THEN 'Semifinal 1' WHEN l_linenumber = 5 THEN 'Semifinal 2' ELSE 'Final' END",
    "section": "concat('Etapa ', CAST(l_orderkey % 4 AS STRING))",
    "venue": "CASE WHEN l_partkey % 13 = 0 THEN ' ' ELSE concat('Ground ', CAST(l_suppkey % 20 AS STRING)) END",
    "neutral": "CASE WHEN l_discount < 0.02 THEN NULL ELSE l_discount > 0.08 END",
    "status": "CASE WHEN l_orderkey % 101 = 0 THEN 'suspended' ELSE '' END",
    "date_credit": "''",
}

#: Another telling of the same matches, as a second source would have them, with ids, and now and then another score. It tells every third order under another page.
EXTERNAL = {
    "page": f"CASE WHEN l_orderkey % 3 = 1 THEN concat('other ', {MATCH['page']}) ELSE {MATCH['page']} END",
    "date": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "matchday": "CASE WHEN l_orderkey % 6 <> 0 THEN CAST(l_linenumber * 2 AS INT) ELSE 0 END",
    "home": MATCH["home"],
    "away": MATCH["away"],
    "hs": f"CASE WHEN l_partkey % 10 = 4 THEN 5 ELSE {MATCH['hs']} END",
    "aws": MATCH["aws"],
    "home_id": "concat('t', CAST(l_suppkey % 20 AS STRING))",
    "away_id": "concat('t', CAST(l_partkey % 20 AS STRING))",
    "section": MATCH["section"],
    "grp": "''",
    "status": "''",
}


def select(view: dict[str, str]) -> list[str]:
    return [f"{e} AS {c}" for c, e in view.items()]


def sql(view: dict[str, str], table: str = "lineitem", where: str = "") -> str:
    return f"SELECT {', '.join(select(view))} FROM {table}" + (f" WHERE {where}" if where else "")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(*select(MATCH))


def external(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(*select(EXTERNAL))


M = f"m AS ({sql(MATCH)})"
X = f"x AS ({sql(EXTERNAL)})"
#: A row for each side of a match.
SIDES = f"""{M},
sides AS (SELECT *, home AS club, away AS rival, hs AS gf, aws AS gc, true AS at_home FROM m UNION ALL SELECT *, away, home, aws, hs, false FROM m)"""
