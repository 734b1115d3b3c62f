"""Every registered query that has SQL, against DuckDB on the small tables; the others must give rows."""

from __future__ import annotations

import pytest

from matchledger.plans.catalog import ORACLE_SQL, QUERIES
from tests.compare import assert_same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert_same(QUERIES[name](spark, SF), ORACLE_SQL[name], SF)


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE_SQL.keys()))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).limit(1).count() == 1
