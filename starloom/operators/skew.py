"""Joins in which single keys hold very many rows."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 1_000_000  # a key of fewer rows is never worth spreading
SAMPLED_HITS = 500  # rows by which a sample shows a hot key


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int | None = None
) -> dict[str, dict]:
    """For each key column: the keys (null included) that hold far more rows than a shuffle
    partition on average and at least HOT_ROWS, or else about ``hot_rows`` if that is given,
    with that estimate.

    Call it on a source table. One pass samples all key columns; as hot is measured by the
    table's own partitions, no column has more hot keys than there are partitions. The answer
    only steers how work is spread: ``spread_join`` gives the same rows for any."""
    if not keys:
        return {}
    least = hot_rows
    if least is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        total = df.count()
        least = max(HOT_ROWS, 2 * total // partitions)
        if total < least:  # no key can have that many rows
            return {key: {} for key in keys}
    fraction = min(1.0, SAMPLED_HITS / least)
    rows = df.select(*keys)
    if fraction < 1:
        rows = rows.sample(fraction, seed=17)
    entries = [F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys]
    counts = (
        rows.select(F.explode(F.array(*entries)).alias("at"))
        .groupBy("at.key", "at.value")
        .count()
        .where(F.col("count") >= least * fraction)
    )
    found: dict[str, dict] = {key: {} for key in keys}
    for key, value, n in counts.collect():
        whole = isinstance(df.schema[key].dataType, T.IntegralType)
        known = int(value) if whole and value is not None else value
        found[key][known] = math.ceil(n / fraction)
    return found


def _ways(key: Column, hot: dict, hot_rows: int) -> Column:
    """Into how many parts a key's rows are cut: 1 unless hot, else a power of two."""
    by_ways = defaultdict(list)
    for value, rows in hot.items():
        by_ways[1 << max(1, math.ceil(math.log2(max(rows / hot_rows, 2))))].append(value)
    out = F.lit(1)
    for ways, values in by_ways.items():
        known = [v for v in values if v is not None]
        if known:
            out = F.when(key.isin(known), F.lit(ways)).otherwise(out)
        if len(known) < len(values):
            out = F.when(key.isNull(), F.lit(ways)).otherwise(out)
    return out


def spread_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    how: str = "inner",
    hot: dict | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Join ``many`` to ``one`` (few rows per ``key``) by name; ``hot`` holds the hot keys found.

    Without hot keys this is a plain join. The rows of a hot key are cut into parts by a hash
    of the row, and its partners in ``one`` are repeated once per part; all other rows stay as
    they are. Null keys are spread too, and need no partner."""
    if how == "inner":  # rows without a key go anyway
        hot = {k: n for k, n in (hot or {}).items() if k is not None}
    if not hot:
        return many.join(one, key, how)
    ways = _ways(F.col(key), hot, hot_rows or HOT_ROWS)
    part = F.pmod(F.xxhash64(*many.columns), ways.cast("bigint")).cast("int")
    parts = F.sequence(F.lit(0), ways - 1)
    left = many.withColumn("_part", part)
    right = one.where(F.col(key).isNotNull()).withColumn("_part", F.explode(parts))
    return left.join(right, [key, "_part"], how).drop("_part")
