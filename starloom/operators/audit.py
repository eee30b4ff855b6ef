"""Checks of declared rules. Each returns the offending keys or one row per rule; none fails."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def audit_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("Rows"))
    return counts.where(F.col("Rows") > 1)


def audit_foreign_key(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None
) -> DataFrame:
    """Non-null child key values without a parent row, with their count. The child is counted
    per key first, so the join sees each value once however often it occurs."""
    counts = (
        child.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("Rows"))
    )
    keys = parent.select(F.col(parent_key or key).alias(key))
    return counts.join(keys, key, "left_anti")


def _per_column(df: DataFrame, counts: Mapping[str, Column], value: str) -> DataFrame:
    """One pass over ``df``; one result row per column."""
    one_row = df.agg(*[c.cast("bigint").alias(name) for name, c in counts.items()])
    return one_row.unpivot([], list(counts), "ColumnName", value)


def audit_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of nulls in each column."""
    return _per_column(df, {c: F.count_if(F.col(c).isNull()) for c in columns}, "NullRows")


def audit_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Number of values longer than declared, per column."""
    too_long = {c: F.count_if(F.length(c) > n) for c, n in limits.items()}
    return _per_column(df, too_long, "TooLong")


def audit_range(df: DataFrame, limits: Mapping[str, tuple]) -> DataFrame:
    """Number of values outside ``(lowest, highest)``, per column."""
    outside = {c: F.count_if(~F.col(c).between(low, high)) for c, (low, high) in limits.items()}
    return _per_column(df, outside, "OutOfRange")


def audit_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Number of values that a tolerant cast to the given type turns into null, per column."""
    lost = {
        c: F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())
        for c, t in types.items()
    }
    return _per_column(df, lost, "Rejected")


def audit_summary(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named check with the number of rows it found."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("Findings")).select(F.lit(name).alias("Rule"), "Findings")
        for name, df in checks.items()
    ]
    return reduce(DataFrame.unionByName, rows)
