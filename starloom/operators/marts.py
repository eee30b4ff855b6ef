"""Revenue reports over a star.

The fact is summed per surrogate key before it meets the dimension: partial sums fold a hot key
inside each task, and the join reads one row per key instead of one per order line. Sums are
decimal(29,4): exact, and far from overflow at any fact size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUM_TYPE = "decimal(29,4)"


def exact_sum(measure: str) -> Column:
    return F.sum(F.col(measure).cast("decimal(19,4)")).cast(SUM_TYPE)


def _per_key(fact: DataFrame, key: str, measure: str, total: str) -> DataFrame:
    return fact.groupBy(key).agg(exact_sum(measure).alias(total))


def _refold(total: str) -> Column:
    """Sum of sums, kept in one type."""
    return F.sum(total).cast(SUM_TYPE).alias(total)


def total_of(fact: DataFrame, measure: str, total: str) -> DataFrame:
    return fact.agg(exact_sum(measure).alias(total))


def revenue_by(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    attrs: Sequence[str],
    measure: str,
    total: str = "TotalRevenue",
) -> DataFrame:
    """Sum of ``measure`` per value of the dimension's ``attrs``. Fact rows whose key is not in
    the dimension, or null, do not count."""
    sums = _per_key(fact, key, measure, total)
    return sums.join(dim.select(key, *attrs), key).groupBy(*attrs).agg(_refold(total))


def largest_first(df: DataFrame, by: str) -> DataFrame:
    """Descending by ``by``; ties in the order of the other columns."""
    return df.orderBy(F.desc(by), *[c for c in df.columns if c != by])


def top_k(df: DataFrame, by: str, k: int) -> DataFrame:
    return largest_first(df, by).limit(k)


def revenue_rollup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    levels: Sequence[str],
    measure: str,
    total: str = "TotalRevenue",
) -> DataFrame:
    """All drill-down levels in one pass, from the grand total to the last of ``levels``.

    ``Level`` is the number of levels given: it tells a subtotal from a null attribute."""
    sums = _per_key(fact, key, measure, total)
    by_leaf = sums.join(dim.select(key, *levels), key).groupBy(*levels).agg(_refold(total))
    given = sum((1 - F.grouping(c) for c in levels), F.lit(0)).cast("int")
    return by_leaf.rollup(*levels).agg(given.alias("Level"), _refold(total))
