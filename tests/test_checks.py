"""Checks fire on bad matches and are silent on good ones; text and date functions on single values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from matchledger.functions import dates, text
from matchledger.operators import checks, joins, reconcile, relational
from matchledger.schema import MATCH

COLUMNS = [c.split()[0] for c in MATCH.split(", ")]


def frame(spark, rows):
    """Rows as dicts over a plain match."""
    base = dict.fromkeys(COLUMNS, "") | {"page": "p", "hs": 1, "aws": 0, "hpens": None, "apens": None, "season": 2000, "phase": "groups", "neutral": None}
    full = [base | {"row_id": f"r{i:03d}"} | r for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in full], MATCH)


def round_robin(n, legs=1):
    """Circle method: every pair once (or twice, home and away)."""
    clubs, rows = [f"C{i}" for i in range(n)], []
    for day in range(n - 1):
        order = [clubs[0], *[clubs[1:][(day + k) % (n - 1)] for k in range(n - 1)]]
        for k in range(n // 2):
            pair = (order[k], order[-1 - k])
            for leg in range(legs):
                h, a = pair if leg == 0 else pair[::-1]
                rows.append({"home": h, "away": a, "date": f"2000-0{1 + leg}-{day + 1:02d}", "matchday": f"Fecha {day + 1 + leg * (n - 1)}", "grp": "Zona A"})
    return rows


def found(df):
    return sorted((r["check"], r["subject"], r["detail"]) for r in df.collect())


def test_a_whole_round_robin_is_silent(spark):
    assert found(checks.review(frame(spark, round_robin(4, 2)))) == []


def test_checks_fire(spark):
    good = round_robin(4, 2)
    bad = [*good, good[0] | {"home": "C1", "away": "C1", "grp": "", "hs": 30}, good[1] | {"date": "", "hpens": 4, "apens": 3}]
    names = {c for c, _, _ in found(checks.review(frame(spark, bad), frame(spark, []).select(F.lit("C0").alias("name"))))}
    assert {"odd_score", "undated", "shootout_without_draw", "self_play", "partial_groups", "unequal_games", "twice_a_matchday"} <= names
    assert found(checks.unknown_names(frame(spark, good), spark.createDataFrame([("C0",), ("C1",)], "name string"))) == [("unknown_club", "2", "C2, C3")]


def test_gaps_and_years(spark):
    rows = [{"home": "A", "away": "B", "matchday": f"Fecha {n}", "date": d} for n, d in ((1, "2000-03-01"), (2, "2000-03-08"), (5, "1999-03-09"), (5, "2000-03-10"), (5, "1999-03-11"))]
    assert found(checks.matchday_gaps(frame(spark, rows))) == [("matchday_gap", "1-5", "3, 4")]
    far = [*rows, {"home": "A", "away": "B", "matchday": "Fecha 2000000000", "date": "2000-03-12"}]
    assert found(checks.matchday_gaps(frame(spark, far))) == [("matchday_gap", "1-2000000000", "3, 4, 6-1999999999")]
    assert found(checks.year_order(frame(spark, rows))) == [("year_order", "5 after 2", "1999-03-11 2000-03-08")]
    even = [{"home": "A", "away": "B", "matchday": "Fecha 1", "date": f"2000-01-0{k}"} for k in (4, 1, 3, 2)]
    assert checks.upper_medians(frame(spark, even)).first()["mid"] == "2000-01-03"


def ko(label, home, away, hs=1, aws=0, day=1, section="S", pens=(None, None)):
    return {"phase": "knockout", "matchday": label, "home": home, "away": away, "hs": hs, "aws": aws, "date": f"2000-01-{day:02d}", "section": section, "hpens": pens[0], "apens": pens[1]}


def test_chain_of_rounds(spark):
    good = [ko("Semifinal 1", "A", "B"), ko("Semifinales", "C", "D", 0, 0, pens=(2, 3)), ko("Final", "A", "D", day=9)]
    assert found(checks.chain(frame(spark, good))) == []
    broken = [*good[:2], ko("Final", "B", "D", day=9)]
    assert found(checks.chain(frame(spark, broken))) == [("chain_broken", "S / 2", "r002 B")]
    fresh = [*good[:2], ko("Final", "A", "Z", day=9)]
    assert found(checks.chain(frame(spark, fresh))) == [("chain_entrants", "S / 2", "Z")]
    drawn = [ko("Semifinales", "A", "B", 0, 0), ko("Semifinales", "C", "D"), ko("Final", "A", "C", day=9)]
    assert found(checks.chain(frame(spark, drawn))) == []
    both_on = [*drawn, ko("Final", "B", "C", day=9)]
    assert [x[0] for x in found(checks.chain(frame(spark, both_on)))] == ["chain_broken", "chain_broken"]


def test_chain_abstains_and_folds_legs(spark):
    parallel = [ko("Llave 1", "A", "B"), ko("Llave 1", "B", "A"), ko("Llave 2", "C", "D")]
    assert found(checks.chain(frame(spark, parallel))) == [("chain_none", "S", "")]
    opaque = [ko("Algo", "A", "B"), ko("Otro", "A", "C"), ko("Tercero", "A", "D")]
    assert found(checks.chain(frame(spark, opaque))) == [("chain_not_reviewed", "S", "")]
    assert found(checks.chain(frame(spark, [ko("Algo", "A", "B")] * 3))) == []
    legs = [ko("Ida", "A", "B", day=1), ko("Ida", "C", "D", day=1), ko("Vuelta", "B", "A", day=2), ko("Vuelta", "D", "C", 0, 1, day=2), ko("Ultima", "A", "C", day=9), ko("Ultima vuelta", "C", "A", day=10)]
    assert found(checks.chain(frame(spark, legs))) == []
    wrong = [*legs[:2], ko("Vuelta", "B", "A", 0, 0, day=2), ko("Vuelta", "D", "C", 0, 1, day=2), ko("Ultima", "A", "D", day=9), ko("Ultima vuelta", "D", "A", day=10)]
    assert {c for c, _, _ in found(checks.chain(frame(spark, wrong)))} == {"chain_broken"}


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) or v is None else 'string'}" for k, v in values.items())).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("told", "want"), [
    ("12 de agosto", "2009-08-12"), ("3 de enero", "2010-01-03"), ("1 de mayo de 2011", "2011-05-01"), ("31 de brumario", ""), ("5 de Setiembre", "2009-09-05"), ("32 de enero", "2010-01-32"), ("sin fecha", ""),
])
def test_season_dates(spark, told, want):
    assert one(spark, dates.iso_date(F.col("t"), F.col("y0"), F.col("y1")), t=told, y0=2009, y1=2010) == want


@pytest.mark.parametrize(("raw", "want"), [
    ("'''[[Club A|A]]'''", "A"), ("A<ref>x | y</ref>", "A"), ("{{nowrap|A {{x}} B}}", "A B"), ("{{nowrap|A", "A"), ("A²", "A"), ("A (*)", "A"), ("(*)", "(*)"), ("A<br>B", "A B"), ("[[Archivo:x.png]] A", "A"),
])
def test_clean(spark, raw, want):
    assert one(spark, text.clean(F.col("t")), t=raw) == want


@pytest.mark.parametrize(("raw", "want"), [("rowspan=3|22 de enero", (3, "22 de enero")), ("Boca", (1, "Boca")), ("[[a|b]]", (1, "b")), ('style="x" | y', (1, "y")), ("", (1, ""))])
def test_cells(spark, raw, want):
    assert one(spark, F.struct(text.cell_span(F.col("t")), text.cell_text(F.col("t"))), t=raw) == want


def test_row_cells_keep_empty_ones(spark):
    assert one(spark, text.row_cells(F.col("t")), t=' bgcolor="#FFF"\n| a || || b<ref>c | d</ref>\n|') == [" a ", " ", " b", ""]


def test_leg_dates_and_times(spark):
    got = one(spark, dates.leg_dates(F.col("t"), F.col("y"), F.col("z")), t="Final 30 de noviembre y 7 de diciembre", y=2009, z=None)
    assert (got["one"], got["two"]) == ("2009-11-30", "2009-12-07")
    assert one(spark, dates.leg_dates(F.col("t"), F.col("y"), F.col("z")), t="Final 3/12", y=2009, z=None)["one"] == ""
    assert one(spark, dates.local_date(F.col("t"), F.lit(True)), t="2008-01-10 02:30:00") == "2008-01-10"
    assert one(spark, dates.local_date(F.col("t"), F.lit(True)), t="2010-01-10 02:30:00") == "2010-01-09"
    assert one(spark, dates.local_date(F.col("t"), F.lit(True)), t="soon") == ""


def test_votes_need_uniqueness_on_both_sides(spark):
    ours = frame(spark, [{"matchday": "Fecha 1", "home": "A", "away": "B", "hs": 2, "aws": 1}, {"matchday": "Fecha 2", "home": "B", "away": "A", "hs": 3, "aws": 0}, {"matchday": "Fecha 3", "home": "A", "away": "B", "hs": 5, "aws": 5}])
    theirs = spark.createDataFrame([("p", 1, 2, 1, "a", "b"), ("p", 2, 3, 0, "b", "a"), ("p", 3, 5, 5, "x", "y"), ("p", 3, 5, 5, "y", "x")], "page string, matchday int, hs int, aws int, home_id string, away_id string")
    got = {(r["ext_id"], r["club"], r["verdict"]) for r in joins.vote_mapping(ours, theirs).collect()}
    assert got == {("a", "A", "accepted"), ("b", "B", "accepted")}


def test_carried_stops_at_the_next_value(spark):
    df = spark.createDataFrame([(i, v, n) for i, (v, n) in enumerate([(None, 0), ("a", 3), (None, 0), (None, 0), (None, 0), ("b", 5), ("c", 1), (None, 0)])], "i int, v string, n int").withColumn("k", F.lit(1))
    got = df.select("i", relational.carried(["k"], ["i"], F.col("v"), F.col("n")).alias("x")).orderBy("i").collect()
    assert [r["x"] for r in got] == [None, "a", "a", "a", None, "b", "c", None]


def test_levels_join_a_club_once_a_competition(spark):
    """The matches are grouped before levels are joined, so that no task sorts them."""
    rows = [{"home": "A", "away": "B", "competition": c} for c in ("One", "One", "Four")]
    got = reconcile.incompatible_levels(frame(spark, rows), spark.createDataFrame([("One", 1), ("Four", 4)], "competition string, level int"))
    assert sorted(tuple(r) for r in got.collect()) == [("A", 2000, 3, "Four, One"), ("B", 2000, 3, "Four, One")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Join") : plan.index("Generate")]


def test_plain_texts_are_cleaned_of_line_breaks(spark):
    raws = ["El Gran Campo\n", "El {{nowrap|Gran}} Campo\n", "Club 3\t", "a\u00a0b", " a  b ", "a b"]
    got = spark.createDataFrame([(r,) for r in raws], "v string").select(text.clean(F.col("v")), text.cell_text(F.col("v"))).collect()
    want = ["El Gran Campo", "El Gran Campo", "Club 3", "a b", "a b", "a b"]
    assert [r[0] for r in got] == want and [r[1] for r in got] == want


def test_the_next_round_is_no_frame_to_the_end(spark, capsys):
    checks.chain(frame(spark, [ko("Final", "a", "b")]), lambda df, name: df).explain()
    assert "rangeframe, 1, unboundedfollowing" not in capsys.readouterr().out.lower()
