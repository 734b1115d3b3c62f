from __future__ import annotations

import pytest

from matchledger.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import assert_same


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    d = "/root/testdata/sf0.01"
    assert assert_same(QUERIES[name](spark, d), ORACLE_SQL[name], d) > 0
