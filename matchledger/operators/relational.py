"""Relational building blocks: as-of labels, top rows, ordered distinct and carried values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """df with these columns, each computed once a row. Columns of withColumn() are put in place of their names, in filters
    and within lambdas too, so that one which is long is computed as often as it is mentioned; what inline() gives is not."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in cols.items())))))


def by_page(df: DataFrame) -> DataFrame:
    """df dealt by page into as many parts as the session's shuffles have. Spark merges parts of its own shuffles by their
    bytes when compressed; pages are alike, so that such parts are many times larger where they are sorted."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "page")


def asof(df: DataFrame, keys: list[str], order: list[str], label: Column) -> Column:
    """The last label that is not null at or before a row."""
    return F.last(label, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def carried(keys: list[str], order: list[str], value: Column, rows: Column) -> Column:
    """A value fills its row and rows - 1 rows after it, unless another begins there. value is null where none begins."""
    w = Window.partitionBy(*keys).orderBy(*order)
    begun = w.rowsBetween(Window.unboundedPreceding, 0)
    at = F.row_number().over(w)
    held = F.last(F.when(value.isNotNull(), F.struct(value.alias("v"), at.alias("at"), rows.alias("rows"))), ignorenulls=True).over(begun)
    return F.when(at < held["at"] + held["rows"], held["v"])


def top1(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each group; give an order that leaves no ties."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rank = 1").drop("__rank")


def ordered_distinct(df: DataFrame, cols: list[str], seq: str) -> DataFrame:
    """Distinct values, each with the place where it occurs first."""
    return df.groupBy(*cols).agg(F.min(seq).alias("first_at"))


def only(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key no other row has: keys that do not identify one row identify none."""
    return df.withColumn("__n", F.count("*").over(Window.partitionBy(*keys))).where("__n = 1").drop("__n")
