"""Places and running sums against Python, with groups larger than a range, nulls and repeated rows."""

from __future__ import annotations

import random
from itertools import accumulate, groupby

import pytest
from pyspark.sql import functions as F

from matchledger.operators import ordering
from matchledger.sinks.shared import cut

R = random.Random(5)
ROWS = [(R.choice([None, "a", "a", "a", "b", f"g{R.randrange(5)}"]), R.choice([None, R.randrange(40)]), i, R.randrange(9)) for i in range(600)]


def sort_key(r):
    return (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "g string, o int, i int, v int")


@pytest.mark.parametrize("parts", ["1", "9"])
def test_places_and_sums_in_groups(spark, rows, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        placed = {r["i"]: r["at"] for r in ordering.positions(rows, ["g"], ["o", "i"], cut, "at").collect()}
        summed = {r["i"]: (r["n"], r["s"]) for r in ordering.running(rows, ["g"], ["o", "i"], {"n": F.lit(1), "s": F.col("v")}, cut).collect()}
        whole = {r["i"]: r["position"] for r in ordering.positions(rows, [], ["g", "o", "i"], cut).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ordered = sorted(ROWS, key=sort_key)
    assert whole == {r[2]: k for k, r in enumerate(ordered)}
    for _, own in groupby(ordered, key=lambda r: r[0]):
        own = list(own)
        assert [placed[r[2]] for r in own] == list(range(len(own)))
        assert [summed[r[2]] for r in own] == list(zip(range(1, len(own) + 1), accumulate(r[3] for r in own)))


def test_empty_and_alike(spark):
    none = spark.createDataFrame([], "g string, o int")
    assert ordering.positions(none, ["g"], ["o"], cut).count() == 0 and ordering.running(none, [], ["o"], {"s": F.lit(1)}, cut).count() == 0
    same = spark.createDataFrame([("a", 1)] * 5, "g string, o int")
    assert sorted(r["position"] for r in ordering.positions(same, ["g"], ["o"], cut).collect()) == list(range(5))
