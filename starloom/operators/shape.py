"""Projection, null rules and de-duplication."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType, tolerant: Iterable[str] = ()) -> DataFrame:
    """Project to ``schema``: its names, order and types, in one select.

    A value that does not fit raises under ANSI mode; in the ``tolerant`` columns it becomes
    null (``audit.audit_cast`` counts those)."""
    tolerant = set(tolerant)

    def column(field: T.StructField):
        source = F.col(field.name)
        if field.name in tolerant:
            return source.try_cast(field.dataType).alias(field.name)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where every one of ``columns`` has a value."""
    return df.dropna(how="any", subset=list(columns))


def first_match(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``, nulls last.

    Spark limits each group before the shuffle as well as after it, so a key that holds a
    large part of the rows sends one row per task."""
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (
        df.withColumn("_place", F.row_number().over(window))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key, always the same one: rows are ordered by all other columns unless
    ``order`` says otherwise, so only identical rows can tie."""
    if order is None:
        order = [c for c in df.columns if c not in set(keys)]
    return first_match(df, keys, order) if order else df.dropDuplicates(list(keys))


def inspect(df: DataFrame, rows: int = 5, quiet: bool = False) -> DataFrame:
    """Print the schema and the first rows; return those rows."""
    head = df.limit(rows)
    if not quiet:
        df.printSchema()
        head.show(rows, truncate=False)
    return head
