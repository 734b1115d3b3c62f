"""The daily refresh as a stream: pages arrive as files, and every batch goes through the whole build and its gate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchledger.plans import build
from matchledger.sinks.shared import cut

PAGE = "page string, fetched timestamp, text string"


def refresh(spark: SparkSession, incoming: str, given: build.Inputs, out: str, checkpoint: str, report: Callable[[int, build.Outcome], None] | None = None) -> StreamingQuery:
    """JSON lines (page, fetched, text) under `incoming` -> published CSV under `out`. Of a page that arrives twice in a batch the latest text counts. A batch that is blocked by the gate writes nothing; batches may run again after a failure, as publishing the same rows changes nothing.

    A batch holds some pages only, so published rows of all other pages are kept as they are."""

    def batch(df: DataFrame, batch_id: int) -> None:
        pages = cut(df.groupBy("page").agg(F.max_by("text", F.struct("fetched", "text")).alias("text")), "arrived")  # Spark knows its size then
        arrived = given.catalog.join(pages.select("page"), "page", "left_semi")
        others = given.catalog.join(arrived.select("page"), "page", "left_anti").withColumn("closed", F.lit(True))
        catalog = arrived.withColumn("closed", F.lit(False)).unionByName(others)
        outcome = build.run(spark, replace(given, pages=pages, catalog=catalog), out)
        if report:
            report(batch_id, outcome)

    source = spark.readStream.schema(PAGE).json(incoming)
    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def live_standings(matches: DataFrame, late: str = "7 days") -> DataFrame:
    """A stream of played matches (at timestamp, season, club, gf, gc) -> standings by season and 30-day window; rows later than the watermark are left out."""
    seen = matches.withWatermark("at", late)
    return seen.groupBy(F.window("at", "30 days"), "season", "club").agg(
        F.count("*").alias("pj"), F.sum("gf").alias("gf"), F.sum("gc").alias("gc"), F.count_if(F.col("gf") > F.col("gc")).alias("g"), F.count_if(F.col("gf") == F.col("gc")).alias("e"), F.count_if(F.col("gf") < F.col("gc")).alias("p"),
    )


def repeated(rows: DataFrame, keys: list[str], at: str) -> StreamingQuery:
    """A stream of rows -> keys that more than one row has, whatever batches these rows come in, under `at`.

    The state is a table of the keys seen, with counts: at/seen, a folder for each batch. A batch adds its own keys and
    looks up only these in what came before; what it finds is at/found. Both folders are replaced if a batch runs again
    after a failure, so nothing is counted twice. Rows may come as late as they like; read found_repeats()."""

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        df.groupBy(*keys).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{at}/seen/batch={batch_id}")
        seen = spark.read.parquet(f"{at}/seen").where(F.col("batch") <= batch_id)
        own = seen.where(F.col("batch") == batch_id).select(*keys)
        total = seen.join(own, keys, "left_semi").groupBy(*keys).agg(F.sum("n").alias("n")).where("n > 1")
        total.write.mode("overwrite").parquet(f"{at}/found/batch={batch_id}")

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", f"{at}/stream").trigger(availableNow=True).start()


def found_repeats(spark: SparkSession, keys: list[str], at: str) -> DataFrame:
    """(keys, n): the keys that repeated() has found so far, with how many rows have them."""
    return spark.read.parquet(f"{at}/found").groupBy(*keys).agg(F.max("n").alias("n"))
