"""Extraction from pages of our own."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from matchledger.sources import wikitext

LEAGUE = """
== Equipos ==
* [[Club Norte (Rosario)|Norte]]
* [[Club Sur|Sur]]
* [[Estadio Viejo|Viejo]]

== Torneo Apertura ==
=== Resultados ===
{| class="wikitable"
! colspan="6" | Fecha 1
|-
! Local !! Resultado !! Visitante !! Estadio !! Fecha !! Hora
|-
| '''Norte''' || 2 - 1 || Sur || La Quinta || rowspan=2|12 de agosto || 16:00
|- bgcolor="#F5FAFF"
| [[Club Este|Este]] || 0:0 || Oeste || || 18:30
|-
| Alfa || {{nowrap|1 – 1 {{small|(4)}} {{small|(5)}}}} || Beta || Campo<ref>nota | con barra</ref> || 3 de enero || 20:00
|}
{| class="wikitable"
! colspan="6" | Interzonales
|-
|Norte
|style="x"|3-0
|Este
|La Quinta
|
|17:00<ref>El partido fue suspendido a los 30 minutos</ref>
|-
|Sur||-||Oeste||||||
|}
=== Goleadores ===
{| class="wikitable"
|-
| Uno || 3-1 || Dos
|}
== Torneo Clausura ==
=== Semifinales ===
{| class="wikitable"
! Equipo 1 !! Resultado !! Equipo 2 !! Estadio !! Fecha !! Hora
|-
| Norte || 1-0 || Oeste || Neutral || 5 de junio || 15:00
|}
=== Llave ===
{| class="wikitable"
|+ style="x"| '''Final 10 y 17 de junio'''
|-
! Local - Ida
! Ida
! Vuelta
! Local - Vuelta
|-
|Norte
|2-1
|0–1(3)
|Alfa
|}
==== Final ====
{{Partido
|local = [[Norte]]
|resultado = 2:1 (1:0)
|visita = Sur
|fecha = {{fecha|20|6|2010}}
|estadio = El {{nowrap|Gran}} Campo
|resultado penalti = 4 - 3
}}
{{Partido
|local = Never closed
|resultado = 1:1
"""
CUP = """
== Octavos de final ==
{| class="wikitable"
! Fecha !! Estadio !! Equipo 1 !! Res. !! Equipo 2
|- bgcolor=#EEE
| 3 de marzo || Uno || Norte || 1-1 <small>(5)</small> - <small>(4)</small> || Sur
|-
| 4 de marzo || Dos || Alfa || - || Beta
|}
== Estadios ==
{| class="wikitable"
|-
| a || b || c || 1-2 || d
|}
"""
STANDINGS = """
== Apertura ==
=== Tabla de posiciones ===
{{Tabla de posiciones equipo|eq=[[Club Norte|Norte]]|g=2|e=1|p=0|gf=5|gc=2|color=x}}
{{Tabla de posiciones equipo|eq=Sur<ref>nota</ref>|g=0|e=1|p=2|gf=2|gc=5}}
== Clausura ==
{| class="wikitable"
! Pos !! Equipo !! Pts !! PJ !! PG !! PE !! PP !! GF !! GC !! Dif
|-
| 1 || [[Club Norte|Norte]] || 7 || 3 || 2 || 1 || 0 || 6 || 2 || +4
|-
| 2 || Sur || 1 || 3 || 0 || 1 || 2 || 2 || 5 || -2
|}
== Tabla de promedios ==
{| class="wikitable"
! Pos !! Equipo !! Pts !! PJ !! PG !! PE !! PP !! GF !! GC !! Dif
|-
| 1 || Norte || 7 || 3 || 2 || 1 || 0 || 6 || 2 || +4
|}
"""
BRACKET = """
{{Copa de 4
|RD1-equipo1 = 1: [[Club Norte|Norte]] |RD1-goles1-1 = 2 |RD1-goles1-2 = (1) |RD1-goles1-3 = 3
|RD1-equipo2 = Sur |RD1-goles2-1 = 0 |RD1-goles2-2 = 1 |RD1-goles2-3 = 1
|RD1-equipo3 = w/o
|RD1-equipo4 = Alfa
|RD2-equipo1 = Norte|RD2-goles1 = '''4'''
|RD2-equipo2 = Alfa|RD2-goles2 = 2
}}
{| class="wikitable"
|-
| Norte || PP-PP || Alfa
|-
| bgcolor=#d0e7ff | Sur || 0-1 || Alfa
|-
| Norte || bgcolor="#D0E7FF"|1-1 || Beta
|-
| Beta || 2-1 || Sur || Según el tribunal, sigue
|}
"""


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([("league", LEAGUE), ("cup", CUP), ("table", STANDINGS), ("bracket", BRACKET), ("empty", ""), ("plain", "no markup")], "page string, text string")


@pytest.fixture(scope="module")
def about(spark):
    return spark.createDataFrame([(p, 2009, 2010, 8, "cup" if p == "cup" else "league") for p in ("league", "cup", "table", "bracket", "empty", "plain")], "page string, first_year int, last_year int, from_month int, layout string")


def test_league_page(pages, about):
    got = wikitext.matches(pages, about, lambda df, name: df.checkpoint()).where("page = 'league'").orderBy("row_id").collect()
    cells = [(r["date"], r["home"], r["hs"], r["aws"], r["away"], r["phase"], r["grp"], r["matchday"], r["section"], r["venue"], r["time"], r["neutral"], r["status"], r["hpens"], r["apens"]) for r in got]
    zone, ko = "groups", "knockout"
    assert cells == [
        ("2009-08-12", "Norte", 2, 1, "Sur", zone, "Torneo Apertura", "Fecha 1", "Torneo Apertura", "La Quinta", "16:00", None, "", None, None),
        ("2009-08-12", "Este", 0, 0, "Oeste", zone, "Torneo Apertura", "Fecha 1", "Torneo Apertura", "", "18:30", None, "", None, None),
        ("2010-01-03", "Alfa", 1, 1, "Beta", zone, "Torneo Apertura", "Fecha 1", "Torneo Apertura", "Campo", "20:00", None, "", 4, 5),
        ("", "Norte", 3, 0, "Este", zone, "Interzonal", "Fecha 1", "Torneo Apertura", "La Quinta", "17:00", None, "suspended", None, None),
        ("2010-06-05", "Norte", 1, 0, "Oeste", ko, "", "Torneo Clausura", "Torneo Clausura", "Neutral", "15:00", True, "", None, None),
        ("2010-06-10", "Norte", 2, 1, "Alfa", ko, "", "Final", "Torneo Clausura", "", "", None, "", None, None),
        ("2010-06-17", "Alfa", 1, 0, "Norte", ko, "", "Final", "Torneo Clausura", "", "", None, "", 3, None),
        ("2010-06-20", "Norte", 2, 1, "Sur", ko, "", "Final", "Torneo Clausura", "El Gran Campo", "", None, "", 4, 3),
    ]


def test_cup_page(pages, about):
    (r,) = wikitext.matches(pages, about).where("page = 'cup'").collect()
    assert (r["date"], r["venue"], r["home"], r["hs"], r["aws"], r["away"], r["hpens"], r["apens"], r["matchday"], r["phase"]) == ("2010-03-03", "Uno", "Norte", 1, 1, "Sur", 5, 4, "Octavos", "knockout")


def test_pages_without_matches(pages, about):
    assert wikitext.matches(pages.where("page in ('empty', 'plain', 'table')"), about).count() == 0


def test_standings_in_both_notations(pages):
    got = wikitext.standings(pages).orderBy("pos").collect()
    assert [(r["club"], r["article"], r["pj"], r["gf"], r["gc"], r["g"], r["e"], r["p"], r["closes"]) for r in got] == [
        ("Norte", "Club Norte", 3, 5, 2, 2, 1, 0, True), ("Sur", "", 3, 2, 5, 0, 1, 2, True), ("Norte", "Club Norte", 3, 6, 2, 2, 1, 0, True), ("Sur", "", 3, 2, 5, 0, 1, 2, False),
    ]


def test_cells_are_cleaned_once(pages):
    """Filters and lambdas behind a column must not compute it anew: the plan is as long as what it does."""
    plan = wikitext.standings(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<sup[^>]*>") <= 12


def test_pages_are_dealt_in_a_fixed_number_of_parts(spark, pages):
    """Parts of lines and pieces are not merged by their bytes when compressed."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert n > 1
    assert wikitext.lines(pages).rdd.getNumPartitions() == n
    assert wikitext.templates(pages, "Copa").rdd.getNumPartitions() == n


def test_bracket(pages):
    slots = {(r["rd"], r["slot"]): (r["name"], r["article"]) for r in wikitext.bracket_slots(pages).collect()}
    assert slots == {(1, 1): ("Norte", "Club Norte"), (1, 2): ("Sur", ""), (1, 4): ("Alfa", ""), (2, 1): ("Norte", ""), (2, 2): ("Alfa", "")}
    legs = sorted((r["one"], r["two"], r["leg"], r["a"], r["b"]) for r in wikitext.bracket_legs(pages).collect())
    assert legs == [("Norte", "Alfa", 1, 4, 2), ("Norte", "Sur", 1, 2, 0), ("Norte", "Sur", 2, 1, 1)]


def test_odd_rows(pages):
    own = wikitext.all_rows(pages.where("page = 'bracket'"))
    assert [(r["home"], r["away"]) for r in wikitext.voided(own).collect()] == [("Norte", "Alfa")]
    assert [(r["home"], r["told"], r["away"]) for r in wikitext.unread_rulings(own).collect()] == [("Beta", "2-1", "Sur")]
    assert [(r["home"], r["away"], r["hs"], r["aws"], r["says"]) for r in wikitext.contradicted_highlights(own).collect()] == [("Sur", "Alfa", 0, 1, "home")]


def test_group_labels_under_two_stages(spark, about):
    block = '== {0} ==\n=== Resultados ===\n{{|\n! colspan="6" | Zona A\n|-\n! colspan="6" | Fecha 1\n|-\n| {1} || 1-0 || {2} || x || 1 de mayo || 1\n|}}\n'
    text = block.format("Primera etapa", "P", "Q") + block.format("Segunda etapa", "R", "S")
    got = {r["home"]: (r["grp"], r["section"]) for r in wikitext.matches(spark.createDataFrame([("league", text)], "page string, text string"), about).collect()}
    assert got == {"P": ("Primera etapa - Zona A", "Primera etapa"), "R": ("Segunda etapa - Zona A", "Segunda etapa")}


def test_links_and_templates(pages):
    got = {(r["article"], r["visible"]) for r in wikitext.links(pages.where("page = 'league'")).collect()}
    assert ("Club Norte (Rosario)", "Norte") in got and ("Club Este", "Este") in got
    found = wikitext.templates(pages, r"Partidos?\s*\n").collect()
    assert len(found) == 1 and "El {{nowrap|Gran}} Campo" in found[0]["body"]
    assert wikitext.headings(wikitext.lines(pages)).where(F.col("page") == "cup").count() == 2


def test_cells_that_reach_down_need_no_join(spark, capsys):
    cells = ["a || 1-1 || b || rowspan=2| g", "c || 2-0 || d || e", "f || 0-0 || h || i || j"]
    rows = spark.createDataFrame([("p", "t", c, k, f"| {x}") for c in (0, 1) for k, x in enumerate(cells[c:])], "page string, block string, carry int, row_no long, row string")
    got = wikitext.filled(rows, 5)
    assert {(r["carry"], r["row_no"]): [x.strip() for x in r["raw"]] for r in got.collect()} == {
        (0, 0): ["a", "1-1", "b", "rowspan=2| g", ""], (0, 1): ["c", "2-0", "d", "rowspan=2| g", "e"], (0, 2): ["f", "0-0", "h", "i", "j"],
        (1, 0): ["c", "2-0", "d", "e", ""], (1, 1): ["f", "0-0", "h", "i", "j"],
    }
    got.explain()
    assert "Join" not in capsys.readouterr().out
