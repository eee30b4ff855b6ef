"""Left lookups of attributes by key."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.skew import spread_join


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "left",
    hot: dict | None = None,
) -> DataFrame:
    """Join ``dim`` and add its ``take`` columns under new names.

    ``on`` maps columns of ``df`` to columns of ``dim``; ``take`` maps columns of ``dim`` to
    result names. The dim is cut down to these columns first, so no other name can clash.
    ``hot`` holds keys of a single-column ``on`` that are to be spread, see ``skew.hot_keys``."""
    keys = {f"_on{i}": right for i, right in enumerate(on.values())}
    right = dim.select(
        *[F.col(source).alias(name) for name, source in keys.items()],
        *[F.col(source).alias(name) for source, name in take.items()],
    )
    if hot and len(on) == 1:
        (left,) = on
        right = right.withColumnRenamed("_on0", left)
        joined = spread_join(df, right, left, how, hot)
        return joined.select(*df.columns, *take.values())
    condition = reduce(and_, [F.col(left) == F.col(key) for left, key in zip(on, keys)])
    return df.join(right, condition, how).drop(*keys)
