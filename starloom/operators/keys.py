"""Dense surrogate keys: 1..n in the order of a unique natural key, without one big task."""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.shape import dedupe
from starloom.staging import settle

ROWS_PER_RANGE = 1_000_000
CUTS = 1024  # percentiles taken in one pass; ranges beyond them divide the space between two


def dense_key(
    df: DataFrame,
    natural_key: str,
    name: str,
    ids: str = "int",
    unique: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``name`` = rank of ``natural_key`` (1..n, no gaps) as the first column.

    The natural key must be unique; pass ``unique=False`` to keep one row per key first. The
    rows are cut into ranges of the key, each range is numbered by its own task, and the sizes
    of the lower ranges are added. Calling this runs jobs: a count with percentiles, or a sort.
    ``ids`` is the key type: ``int`` raises beyond 2^31 rows, ``bigint`` does not."""
    if not unique:
        df = settle(dedupe(df, [natural_key]), name)
    if isinstance(df.schema[natural_key].dataType, T.NumericType):
        total, cuts = _cuts(df, natural_key, rows_per_range)
        ranges = max(1, math.ceil(total / rows_per_range))
        rows, rank = _number_by_cuts(df, natural_key, ranges, cuts)
    else:
        rows, rank = _number_sorted(df, natural_key, name)
    return rows.select(rank.cast(ids).alias(name), *df.columns)


def stable_key(
    df: DataFrame,
    natural_key: str,
    name: str,
    held: DataFrame | None,
    ids: str = "int",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``dense_key`` for a table that grows: rows whose natural key is in ``held(natural_key,
    name)`` keep their number, the others get the numbers after the highest one held.

    Without ``held`` all rows are numbered from 1. A null natural key is a key."""
    if held is None:
        return dense_key(df, natural_key, name, ids, rows_per_range=rows_per_range)
    known = held.select(F.col(natural_key).alias("_held"), F.col(name).cast(ids).alias(name))
    same = F.col(natural_key).eqNullSafe(F.col("_held"))
    top = held.agg(F.max(name)).first()[0] or 0
    fresh = settle(df.join(known, same, "left_anti"), name)
    fresh = dense_key(fresh, natural_key, name, "bigint", rows_per_range=rows_per_range)
    fresh = fresh.withColumn(name, (F.col(name) + top).cast(ids))
    return df.join(known, same).select(name, *df.columns).unionByName(fresh)


def _cuts(df: DataFrame, key: str, rows_per_range: int) -> tuple[int, list[float]]:
    """Rows, and evenly spaced approximate percentiles of the key where one range is too small."""
    total = df.select(key).count()
    if total <= rows_per_range:
        return total, []
    shares = ", ".join(f"{i / CUTS!r}D" for i in range(1, CUTS))
    cuts = F.expr(f"percentile_approx(CASE WHEN NOT isnan(`{key}`) THEN `{key}` END, array({shares}), 10000)")
    (found,) = df.agg(cuts).first()
    return total, sorted({float(c) for c in found or [] if math.isfinite(c)})


def _number_by_cuts(
    df: DataFrame, key: str, ranges: int, cuts: list[float]
) -> tuple[DataFrame, Column]:
    """Ranges between approximate percentiles. The cuts enter the plan as literals, so a
    retried task puts every row into the same range; they only steer balance, never results.

    Beyond CUTS ranges each is divided again, evenly between its cuts. Null comes first, as
    a range of its own, and NaN last: the cuts take neither."""
    step = max(1, len(cuts) // ranges)
    chosen = cuts[::step] if ranges > 1 else []
    inner = max(1, math.ceil(ranges / (len(chosen) + 1)))
    value = F.col(key).cast("double")
    lows = [math.nan, *chosen]
    highs = [*chosen, math.nan]
    splits = [-math.inf, *chosen, math.inf]
    number = df.withColumn("_value", F.when(~F.isnan(value), value))
    if chosen:
        number = Bucketizer(
            splits=splits, inputCol="_value", outputCol="_cut", handleInvalid="keep"
        ).transform(number)
        cut = F.col("_cut").cast("int")
    else:
        cut = F.lit(0)
    part = F.lit(0)
    if inner > 1:
        low = F.array(*[F.lit(x) for x in lows])[cut]
        high = F.array(*[F.lit(x) for x in highs])[cut]
        share = (F.col("_value") - low) / (high - low)
        part = F.when(F.isnan(share), 0).otherwise(
            F.greatest(F.lit(0), F.least(F.lit(inner - 1), F.floor(share * inner)))
        )
    ranged = number.withColumn(
        "_range",
        F.when(F.col(key).isNull(), -1)
        .when(F.isnan(value), len(splits) * inner)
        .otherwise(cut * inner + part)
        .cast("int"),
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return _with_offsets(ranged, "_range", place)


def _number_sorted(df: DataFrame, key: str, name: str) -> tuple[DataFrame, Column]:
    """For keys without percentiles: a global sort, written once with each row's position in
    its sorted partition (the low 33 bits of the running id; the partition is above them)."""
    rows = df.orderBy(key).withColumn("_row", F.monotonically_increasing_id())
    rows = settle(rows, f"{name}_sorted")
    rows = rows.withColumn("_range", F.shiftright("_row", 33).cast("int"))
    return _with_offsets(rows, "_range", F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1)


def _with_offsets(df: DataFrame, range_col: str, place: Column) -> tuple[DataFrame, Column]:
    """Rows with the number of rows in all lower ranges, and their rank. One count per range
    is collected, a row for each million of the table's, and sent to the tasks: Spark does not know
    the size of a list from the driver and would send the numbered rows instead."""
    counts = sorted(df.groupBy(range_col).count().collect())
    before = accumulate((row[1] for row in counts), initial=0)
    offsets = df.sparkSession.createDataFrame(
        [(row[0], offset) for row, offset in zip(counts, before)],
        f"{range_col} int, _offset bigint",
    )
    ranked = df.withColumn("_place", place)
    return ranked.join(F.broadcast(offsets), range_col), F.col("_place") + F.col("_offset")
