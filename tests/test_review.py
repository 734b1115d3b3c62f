"""Checks over folded matches, and shootouts by sums of series."""

from __future__ import annotations

import random

from matchledger.operators import checks
from matchledger.schema import MATCH
from matchledger.sinks.shared import cut


def frame(spark, n=400):
    pick = random.Random(5).choice
    rows = [(
        pick("pq"), f"r{i}", pick(["", "2009-01-01"]), "", pick(["A", "B", "C", ""]), pick(["A", "B", "D", None]), pick([0, 1, 2, None]), pick([0, 1, 2]), pick([None, 4]), 3, "", 2009,
        pick(["groups", "groups", "knockout", None]), pick(["", "Zona 1", "Zona 2"]), pick(["", "Fecha 1", "Fecha 3", "Final"]), pick(["E1", "E2", None]), "", None, "", "",
    ) for i in range(n)]
    return spark.createDataFrame(rows, MATCH)


def told(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_folded_matches_give_the_same_findings(spark):
    m = cut(frame(spark), "m")
    few = checks.folded(m)
    assert few.count() < m.count() == few.agg({"times": "sum"}).collect()[0][0]
    known = spark.createDataFrame([("A",)], "name string")
    each = {name: (checks.CHECKS[name](m), checks.CHECKS[name](few)) for name in checks.FOLDS} | {"unknown_names": (checks.unknown_names(m, known), checks.unknown_names(few, known))}
    for name, (whole, folded) in each.items():
        assert told(whole) == told(folded), name
    assert all(told(each[name][0]) for name in ("partial_groups", "round_robin", "once_per_matchday", "one_group", "home_balance", "unknown_names"))


def test_shootouts_sort_no_matches(spark):
    # level on aggregate in two legs; in three; in two, where a stage is null; and a group match
    leg = lambda i, home, away, hs, aws, section="E", pens=4, phase="knockout": ("p", f"r{i}", "2009-01-01", "", home, away, hs, aws, pens, 3, "", 2009, phase, "", "Final", section, "", None, "", "")
    rows = [leg(1, "A", "B", 1, 0, pens=None), leg(2, "B", "A", 1, 0), *(leg(i, "C", "D", 1, 0) for i in (3, 4, 5)), leg(6, "A", "B", 2, 0, None, None), leg(7, "B", "A", 2, 0, None), leg(8, "A", "B", 1, 0, phase="groups"), leg(9, "E", "F", 1, 0)]
    got = checks.shootouts(spark.createDataFrame(rows, MATCH))
    assert sorted(r["subject"] for r in got.collect()) == ["r3", "r4", "r5", "r8", "r9"]
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
