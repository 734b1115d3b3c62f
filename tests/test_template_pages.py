"""Templates are cut out of pages one by one, and what no reader asks for stays out of the outline."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from matchledger.functions.text import unwrapped
from matchledger.sources import wikitext

PAGE = "== Torneo ==\n==== Final ====\n" + "{{Partido\n|local = [[A]]\n|resultado = 1:0\n|visita = B\n|Local=C\n|fecha = {{fecha|3|3|2010}}\n|estadio = El {{nowrap|Gran}} Campo\n}}\n" * 3


@pytest.fixture(scope="module")
def about(spark):
    return spark.createDataFrame([("p", 2009, 2010, 8, "league"), ("c", 2009, 2010, 8, "cup")], "page string, first_year int, last_year int, from_month int, layout string")


def test_the_outline_has_what_readers_ask_for(spark, about):
    table = '{| class="x"\n|-\n| 3 de marzo || Uno || A || 1-0 || B\n|}\n'
    pages = spark.createDataFrame([("p", PAGE), ("c", "prose\n== Final ==\nprose\n" + table)], "page string, text string")
    got = {r["page"]: r["n"] for r in wikitext.outline_of(pages, about).groupBy("page").agg(F.count("*").alias("n")).collect()}
    assert got == {"p": 2, "c": 7}  # the headings; all since the round, with the last empty line
    places = {r["pos"] for r in wikitext.outline_of(pages, about).where("page = 'p' and level is not null").collect()}
    assert places == {0, 13}


def test_templates_are_read_once(spark, about):
    pages = spark.createDataFrame([("p", PAGE)], "page string, text string")
    df = wikitext.matches(pages, about, outline=wikitext.outline_of(pages, about).checkpoint())
    assert df._jdf.queryExecution().optimizedPlan().toString().count("posexplode(split(text") == 1
    got = df.select("home", "away", "hs", "aws", "date", "venue", "matchday", "section").collect()
    assert [tuple(r) for r in got] == [("C", "B", 1, 0, "2010-03-03", "El Gran Campo", "Final", "Torneo")] * 3


def by_pieces(text):
    """(pos, body) as the text's pieces tell, one by one."""
    pieces = [p for p in re.split(r"(?=\{\{|\}\})", text) if p]
    pos, depth, found, own = 0, 0, [], None
    for p in pieces:
        depth += 1 if p.startswith("{{") else -1 if p.startswith("}}") else 0
        if re.match(r"(?i)\{\{\s*(?:P\n)", p):
            own = [pos, depth, ""]
        if own and depth < own[1]:
            found.append((own[0], own[2][2:]))
            own = None
        if own:
            own[2] += p
        pos += len(p)
    return sorted(found)


def test_odd_braces(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["{{P\n", "{{", "}}", "{", "}", "a", "\n", "{{ p\n", "{{x}}"]) for _ in range(rng.randint(0, 24))) for _ in range(600)]
    pages = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "page string, text string")
    got: dict[str, list] = {}
    for r in wikitext.templates(pages, "P\n").collect():
        got.setdefault(r["page"], []).append((r["pos"], r["body"]))
    assert {str(k): by_pieces(t) for k, t in enumerate(texts) if by_pieces(t)} == {k: sorted(v) for k, v in got.items()}


def test_flat_wrappers_are_like_nested_ones(spark):
    texts = ["a {{nowrap|b}} c {{x|y}}", "{{ NoWrap |b|c}}", "{{nowrap|a}}}", "{{nowrap|{{a}}}}", "{{{nowrap|a}}", "{{nowrap|a", "a}} {{nowrap|b}}", "{{nowrap|a}} {{nowrap|b}}"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", unwrapped(F.col("t")).alias("u")).collect()
    assert {r["t"]: r["u"] for r in rows} == {
        "a {{nowrap|b}} c {{x|y}}": "a b c {{x|y}}", "{{ NoWrap |b|c}}": "b|c", "{{nowrap|a}}}": "a}", "{{nowrap|{{a}}}}": "{{a}}", "{{{nowrap|a}}": "{a",
        "{{nowrap|a": "a", "a}} {{nowrap|b}}": "a}} b", "{{nowrap|a}} {{nowrap|b}}": "a b",
    }
