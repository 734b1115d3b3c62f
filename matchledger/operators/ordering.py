"""Order over whole groups without one task for each: places and running sums from ranges, their totals and prefix sums.

Rows are dealt by ranges of (keys, order) and sorted within them, so a group that is large spreads over several
ranges, and one that is small shares its range. What a range adds to those behind it is one row for each range and
group; only these rows meet in a window. Row numbers within a range come with the sort, so places need no window at all.

`keep` writes a table and reads it back (build.cut): the order is fixed there, and a task that is repeated after a lost
executor finds the same rows. Nulls come first in keys and order. Rows that are alike in keys and order may be placed
in either order, so give an order that leaves no ties where it matters. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keep = Callable[[DataFrame, str], DataFrame]
_LOCAL = 33  # monotonically_increasing_id() holds the number of the range above so many bits of places


def _dealt(df: DataFrame, keys: list[str], order: list[Column | str], keep: Keep) -> DataFrame:
    """df, written by ranges, with __at (grows with the order) and __part (its range)."""
    got = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    return keep(got.withColumn("__at", F.monotonically_increasing_id()), "ordered").withColumn("__part", F.shiftright("__at", _LOCAL))


def _by_part(rows: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """rows with what blocks tell of their range and group; keys may be null."""
    own = blocks.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col("__part").alias("__p"), *(c for c in blocks.columns if c not in [*keys, "__part"]))
    same = [F.col("__part") == F.col("__p"), *(F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys))]
    return rows.join(own, same).drop("__p", *(f"__k{i}" for i in range(len(keys))))


def _before(keys: list[str]):
    """The ranges of a group before a range; as many rows as there are ranges."""
    return Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)


def positions(df: DataFrame, keys: list[str], order: list[Column | str], keep: Keep, to: str = "position") -> DataFrame:
    """df with each row's place in its group, from 0. Without keys, the place in the whole table."""
    rows = _dealt(df, keys, order, keep)
    blocks = rows.groupBy("__part", *keys).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    shifts = blocks.select("__part", *keys, (F.coalesce(F.sum("__n").over(_before(keys)), F.lit(0)) - F.col("__first")).alias("__shift"))
    return _by_part(rows, shifts, keys).withColumn(to, F.col("__at") + F.col("__shift")).select(*df.columns, to)


def running(df: DataFrame, keys: list[str], order: list[Column | str], sums: dict[str, Column], keep: Keep) -> DataFrame:
    """df with running sums: each is the sum of its expression (never null) over the rows of the group up to and with this one."""
    rows = _dealt(df.withColumns({f"__v_{c}": v for c, v in sums.items()}), keys, order, keep)
    within = Window.partitionBy("__part", *keys).orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", *(F.sum(f"__v_{c}").over(within).alias(f"__s_{c}") for c in sums))
    blocks = rows.groupBy("__part", *keys).agg(*(F.sum(f"__v_{c}").alias(f"__t_{c}") for c in sums))
    shifts = blocks.select("__part", *keys, *(F.sum(f"__t_{c}").over(_before(keys)).alias(f"__b_{c}") for c in sums))
    whole = lambda c: F.when(F.col(f"__b_{c}").isNull(), F.col(f"__s_{c}")).otherwise(F.col(f"__s_{c}") + F.col(f"__b_{c}")).alias(c)
    return _by_part(local, shifts, keys).select(*df.columns, *(whole(c) for c in sums))
