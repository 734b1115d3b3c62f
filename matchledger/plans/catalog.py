"""The registered queries and, for each that SQL can express, the same query in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchledger.plans import build_queries, check_queries, flow_queries, join_queries, page_queries, reconcile_queries, text_queries

_PARTS = (check_queries, reconcile_queries, join_queries, text_queries, flow_queries, page_queries, build_queries)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for part in _PARTS for k, f in part.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: q for part in _PARTS for k, q in part.ORACLE_SQL.items()}
