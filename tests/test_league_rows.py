"""Rows of league tables: what is told of a row is told once, and shortcuts give what the long way gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchledger.functions import text
from matchledger.sources import wikitext

ROWS = [
    "| a || b<ref>x || y</ref> || c", "|a\n|b ||| c\n|d<ref name='k'/>", "! x | y", "no bar", "", "|", "||", "| PP-PP || x<REF>q</REF> || z\n|", "|a<b|c",
]


def test_cells_are_those_of_the_long_way(spark):
    flat = F.regexp_replace(F.regexp_replace("row", r"(?is)<ref[^>]*>.*?</ref>|<ref[^>]*/>", ""), r"\|\|", "\n|")
    parts = F.split(F.concat(F.lit("\n"), flat), r"\n\|", -1)
    long = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    rows = spark.createDataFrame([(r,) for r in ROWS], "row string").select("row", text.row_cells(F.col("row")).alias("got"), long.alias("want")).collect()
    assert len(rows) == len(ROWS) and all(r["got"] == r["want"] for r in rows), rows


def test_a_note_is_looked_for_once(spark):
    """The expression that looks for a day in a note was in the plan wherever a part of the day was."""
    pages = spark.createDataFrame([], "page string, text string")
    about = spark.createDataFrame([], "page string, first_year int, last_year int, from_month int, layout string")
    outline = wikitext.outline_of(pages, about).checkpoint()
    plan = wikitext.matches(pages, about, outline=outline)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("jug[oó]|jugaron|disput[oó]|disputaron)") == 1


def test_void_rows_however_they_are_marked(spark):
    cells = ["PP-PP", "'''pp''' - <b>PP</b>", "P''P-P''p", "PP-P", "P-PPP", "1-1"]
    rows = spark.createDataFrame([("p", k, f"| H{k} || {x} || A") for k, x in enumerate(cells)], "page string, pos long, row string")
    assert sorted(r["home"] for r in wikitext.voided(rows).collect()) == ["H0", "H1", "H2"]
