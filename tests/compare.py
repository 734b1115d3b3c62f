"""Compares a registered query with its SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def from_sql(sql: str, sf_dir: str) -> pd.DataFrame:
    with duckdb.connect() as con:
        con.execute("SET TimeZone = 'UTC'")
        for p in Path(sf_dir).glob("*.parquet"):
            at = p if p.is_file() else p / "*.parquet"
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{at}'")
        return con.execute(sql).df()


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
            return tuple(plain(x) for x in v)
        if v is None or v is pd.NaT or (not isinstance(v, (str, bool)) and pd.isna(v)):
            return None
        if hasattr(v, "item"):
            v = v.item()
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) if not isinstance(v, (str, bool)) else v

    cols = sorted(df.columns)
    return sorted((tuple(plain(v) for v in r) for r in df[cols].itertuples(index=False)), key=repr)


def assert_same(spark_df, sql: str, sf_dir: str) -> int:
    got, want = spark_df.toPandas(), from_sql(sql, sf_dir)
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    assert len(a) == len(b), (len(a), len(b))
    wrong = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    assert not wrong, (len(wrong), len(a), wrong[:3])
    return len(a)
