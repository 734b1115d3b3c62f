"""The build end to end on small pages: publishing, reuse, the gate and the guard against shrinking."""

from __future__ import annotations

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from matchledger.plans import build
from matchledger.schema import PUBLISHED_COLUMNS
from matchledger.sinks import published as sink
from matchledger.sources import published
from matchledger.streaming import refresh

CLUBS = ["Norte", "Sur", "Este", "Oeste"]


def page(rows):
    body = "\n".join(f"|-\n| {h} || {s} || {a} || x || {d} || 16:00" for h, s, a, d in rows)
    return f'== Torneo ==\n=== Resultados ===\n{{|\n! colspan="6" | Fecha 1\n{body}\n|}}\n'


@pytest.fixture(scope="module")
def given(spark):
    pages = spark.createDataFrame([("p1", page([("Norte", "2-1", "Sur", "5 de mayo"), ("Este", "0-0", "Oeste", "6 de mayo")])), ("p2", page([("Sur", "1-0", "Norte", ""), ("Este", "3-1", "Oeste", "7 de mayo")]))], "page string, text string")
    catalog = spark.createDataFrame(
        [("p1", "http://x/p1", "Liga", 2009, None, 8, "league", False, True), ("p2", "http://x/p2", "Copa", 2010, None, 8, "league", None, False)],
        "page string, url string, tournament string, season int, last_year int, from_month int, layout string, neutral boolean, closed boolean",
    )
    registry = spark.createDataFrame([(f"Club {c}", None, [c]) for c in CLUBS], "entity string, ext_id int, aliases array<string>")
    return build.Inputs(pages, catalog, registry)


def files(out):
    return {str(p.relative_to(out)): p.read_bytes() for p in sorted(Path(out).rglob("*.csv"))}


def test_publish_reuse_and_guards(spark, given, tmp_path):
    out = str(tmp_path / "data")
    # pages arrive as a stream; of a page that comes twice the later text counts
    arrived = [(r["page"], "2024-01-02T00:00:00Z", r["text"]) for r in given.pages.collect()] + [("p2", "2024-01-01T00:00:00Z", "old")]
    spark.createDataFrame(arrived, "page string, fetched string, text string").write.json(str(tmp_path / "in"))
    seen = []
    refresh.refresh(spark, str(tmp_path / "in"), given, out, str(tmp_path / "ck"), lambda k, o: seen.append((k, o.code, o.written))).awaitTermination(600)
    assert seen == [(0, 0, {"dated": {"2009": 2, "2010": 1}, "undated": {"2010": 1}})]
    before = files(out)
    text = next(v for k, v in before.items() if "dated/partition=2009" in k).decode()
    assert text == ",".join(PUBLISHED_COLUMNS) + "\n2009-05-05,16:00,Club Norte,Club Sur,2,1,,,Liga,2009,groups,Torneo,Fecha 1,x,false,http://x/p1,\n2009-05-06,16:00,Club Este,Club Oeste,0,0,,,Liga,2009,groups,Torneo,Fecha 1,x,false,http://x/p1,\n"
    # closed pages are not read again, and nothing is written anew; a dry run writes nothing
    closed = replace(given, catalog=given.catalog.withColumn("closed", F.lit(True)), pages=given.pages.limit(0))
    again = build.run(spark, closed, out)
    assert again.code == 0 and again.written == {"dated": {}, "undated": {}} and files(out) == before
    assert build.run(spark, closed, out, dry=True).written == {}
    # a page that shrinks blocks, and so does one that could not be fetched
    fewer = replace(given, pages=spark.createDataFrame([("p2", page([("Sur", "1-0", "Norte", "")]))], "page string, text string"))
    blocked = build.run(spark, fewer, out)
    assert blocked.code == 1 and [(r["tournament"], r["season"], r["vanished"]) for r in blocked.lost.collect()] == [("Copa", 2010, True)] and files(out) == before
    assert build.run(spark, given, out, failed=given.catalog.select("page").limit(1)).code == 1
    # a season without rows goes
    kept = published.current(spark, out, "dated").where("season = 2009").checkpoint()
    assert sink.publish(spark, {"dated": kept}, out) == {"dated": {"2010": 0}}
    assert {r["season"] for r in published.current(spark, out, "dated").collect()} == {2009} and published.current(spark, out, "undated").count() == 1


def test_severe_findings_block(spark, given, tmp_path):
    bad = replace(given, pages=spark.createDataFrame([("p1", page([("Nadie", "2-1", "Nadie", "5 de mayo")]))], "page string, text string"))
    got = build.run(spark, bad, str(tmp_path / "data"))
    assert got.code == 1 and not Path(tmp_path / "data").exists()
    assert {"unknown_club", "self_play"} <= {r["check"] for r in got.findings.where("severe").collect()}


def test_amendments_and_second_sources(spark, given):
    score = spark.createDataFrame([("a1", "p1", "Fecha 1", "Club Norte", "Club Sur", 2, 1, 5, 1, None, None), ("a2", "p1", "Fecha 1", "Club Norte", "Club Sur", 9, 9, 1, 1, None, None)], "amendment string, page string, matchday string, home string, away string, hs int, aws int, to_hs int, to_aws int, to_hpens int, to_apens int")
    ext = spark.createDataFrame([("p2", "2010-08-01", 1, "Sur", "Norte", 1, 0, "t1", "t2", "", "", ""), ("p2", "2010-08-02", 1, "Este", "Oeste", 0, 1, "t3", "t4", "", "", "")], "page string, date string, matchday int, home string, away string, hs int, aws int, home_id string, away_id string, section string, grp string, status string")
    got = build.process(replace(given, amendments={"score": score}, sources={"other": build.resolved(ext, given.registry)}))
    rows = {(r["page"], r["home"]): (r["date"], r["hs"], r["date_credit"]) for r in got.matches.collect()}
    assert rows[("p1", "Club Norte")] == ("2009-05-05", 5, "") and rows[("p2", "Club Sur")] == ("2010-08-01", 1, "other") and rows[("p2", "Club Este")][0] == "2010-05-07"
    told = {(r["check"], r["subject"], r["severe"]) for r in got.findings.collect()}
    assert ("amendment_score", "a2", True) in told and ("dates_filled", "other", False) in told


def test_header_must_be_a_beginning(spark, tmp_path):
    ok, bad = tmp_path / "ok", tmp_path / "bad"
    ok.mkdir(), bad.mkdir()
    (ok / "a.csv").write_text(",".join(PUBLISHED_COLUMNS[:-1]) + '\n2009-01-01,,"A ""x"", b",B,1,0,,,T,2009,groups,,F,v,true,u\n')
    (ok / "b.csv").write_text(",".join(PUBLISHED_COLUMNS) + "\n,,C,D,,,,,T,2009,groups,,F,v,,u,desk\n")
    got = {r["home_team"]: r for r in published.read(spark, str(ok / "*.csv")).collect()}
    assert got['A "x", b']["status"] == "" and got['A "x", b']["neutral"] is True and got["C"]["home_score"] is None and got["C"]["status"] == "desk" and got["C"]["date"] == ""
    (bad / "a.csv").write_text("date,home_team\n2009-01-01,A\n")
    with pytest.raises(ValueError, match="header"):
        published.read(spark, str(bad / "*.csv"))
    assert published.read_previous(spark, str(tmp_path / "none/*.csv")).count() == 0


def test_changes_by_season(spark):
    def rows(*r):
        return spark.createDataFrame([("2009-01-01", "", h, "B", s, 0, None, None, "T", y, "groups", "", "", "", None, "u", "") for h, s, y in r], published.PUBLISHED)

    old = rows(("A", 1, 2008), ("A", 1, 2009), ("C", 2, 2009))
    assert sink.changes(rows(("C", 2, 2009), ("A", 1, 2009), ("A", 1, 2008)), old).count() == 0
    assert {(r["season"], r["n"]) for r in sink.changes(rows(("A", 1, 2009), ("C", 3, 2009), ("Z", 1, 2010)), old).collect()} == {("2008", 0), ("2009", 2), ("2010", 1)}
