"""Sorted tables in ranges: what a window over a whole key would do, without one task per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.staging import settle

RANGE, PLACE = "_range", "_place"


def in_ranges(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` sorted by ``order`` over all tasks, written, with columns ``_range``, the number of a
    row's task, and ``_place``, which ascends over the whole table.

    Rows equal in ``order`` come in any order and may lie in several ranges, so a key of any size
    is spread."""
    keys = [*order, "_tie"]
    tie = df.withColumn("_tie", F.monotonically_increasing_id())
    rows = tie.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    placed = settle(rows.withColumn(PLACE, F.monotonically_increasing_id()), name)
    return placed.withColumn(RANGE, F.shiftright(PLACE, 33))


def before_in_range(keys: Sequence[str]):
    """The rows before a row, of its key and range."""
    window = Window.partitionBy(*keys, RANGE).orderBy(PLACE)
    return window.rowsBetween(Window.unboundedPreceding, -1)


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Null-safe equality, column by column."""
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def with_carry(
    placed: DataFrame, keys: Sequence[str], folds: Mapping[str, tuple[str, Column]]
) -> DataFrame:
    """``placed`` with a column for each fold: its value over the earlier ranges of the key, null
    in the first. A fold is ``max``, ``min`` or ``sum`` of an expression. A key has one row a range
    while they are put in order, whatever its number of rows."""
    functions = {"max": F.max, "min": F.min, "sum": F.sum}
    names = [f"_{i}" for i in range(len(keys))]
    parts = placed.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(RANGE).alias("_r"))
    parts = parts.agg(*[functions[f](c).alias(name) for name, (f, c) in folds.items()])
    earlier = Window.partitionBy(*names).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        *names, "_r", *[functions[f](name).over(earlier).alias(name) for name, (f, _) in folds.items()]
    )
    # written: its true size tells whether it is broadcast
    carried = settle(carried, "carries")
    return placed.join(carried, same([*keys, RANGE], [*names, "_r"])).drop(*names, "_r")


def numbered(placed: DataFrame, name: str, after: int = 0) -> DataFrame:
    """Rows of ``in_ranges`` with column ``name``: after + 1, after + 2 and so on in their order.
    Only the ranges' sizes are put in order together."""
    sizes = placed.groupBy(F.col(RANGE).alias("_r")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(PLACE).alias("_first")
    )
    earlier = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    sizes = settle(sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), "sizes")
    rows = placed.join(sizes, F.col(RANGE) == F.col("_r"))
    number = F.col(PLACE) - F.col("_first") + F.col("_before") + (after + 1)
    return rows.withColumn(name, number).drop("_r", "_n", "_first", "_before", RANGE, PLACE)
