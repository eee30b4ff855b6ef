"""Joins of spans of time by key, and checks of a key's spans.

A span is a pair of columns: first and last day (or time, or number), both inclusive. A null first
is open to the past, a null last is still in force. A span that ends before it starts holds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.ranges import before_in_range, in_ranges, with_carry
from starloom.operators.skew import HOT_ROWS, _ways
from starloom.staging import settle

Span = tuple[str, str]
#: A bucket of one level is as wide as 2**STEP of the level below; beyond the ends nothing is counted.
STEP, LEVELS, PAST, FUTURE = 4, 15, -(1 << 60), 1 << 60
#: Up to so many spans on the right Spark may send to every task if it takes them for small.
FEW_SPANS = 100_000


def units(df: DataFrame, column: str) -> Column:
    """The column as a whole number: days of a date, microseconds of a time, a number itself."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("bigint")
    raise TypeError(f"{column} is a {kind.simpleString()}: spans are of dates, times or whole numbers")


def from_units(number: Column, kind: T.DataType) -> Column:
    """The way back. The open ends are null."""
    number = F.when((number > PAST) & (number < FUTURE), number)
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(number.cast("int"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(number).cast(kind)
    return number.cast(kind)


def _bounded(df: DataFrame, span: Span, names: Span) -> DataFrame:
    start, end = span
    last = F.lit(FUTURE) if start != end else F.lit(None).cast("bigint")
    first = F.lit(PAST) if start != end else F.lit(None).cast("bigint")
    return df.withColumns(
        {names[0]: F.coalesce(units(df, start), first), names[1]: F.coalesce(units(df, end), last)}
    )


def _common_time(sides: Sequence[tuple[DataFrame, Span]]) -> tuple[int, int, list[int]]:
    """From the later of the first starts to the earlier of the last ends; open ends reach to the
    furthest day that is named on any side, as spans that meet beyond it meet there too. And the
    number of spans on each side."""
    outer, named, sizes = [], [], []
    for df, (start, end) in sides:
        ends = F.array(start, end)
        finite = F.filter(ends, lambda x: (x > PAST) & (x < FUTURE))
        row = df.where(F.col(start) <= F.col(end)).agg(
            F.min(start), F.max(end), F.min(F.array_min(finite)), F.max(F.array_max(finite)), F.count(F.lit(1))
        ).first()
        if row[0] is None:
            return 0, -1, [0] * len(sides)
        outer.append(row[:2])
        named += [x for x in row[2:4] if x is not None]
        sizes.append(row[4])
    named = named or [0]
    low, high = max(x for x, _ in outer), min(x for _, x in outer)
    return max(low, min(named)), min(high, max(named)), sizes


def _level(length: Column) -> Column:
    """The lowest level whose buckets are at least as wide as the span."""
    return reduce(
        Column.__add__, [(length > (1 << STEP * k)).cast("int") for k in range(LEVELS)], F.lit(0)
    )


def _levels(df: DataFrame, level: str) -> list[int]:
    return sorted(df.agg(F.collect_set(level)).first()[0])


def _bucket(time: Column, level: Column) -> Column:
    return F.call_function("shiftright", time, level * STEP)


def _spread(df: DataFrame, span: Span, own: str, others: Sequence[int], side: str) -> DataFrame:
    """A row for each bucket in which the span can meet one of the other side: at its own level
    those that are as short or shorter, at each higher level those of that level."""
    all_levels = F.array(*[F.lit(k) for k in range(LEVELS + 1)])
    theirs = F.array(*[F.lit(k) for k in others]).cast("array<int>")
    wanted = F.filter(
        all_levels,
        lambda k: ((k > F.col(own)) & F.array_contains(theirs, k))
        | ((k == F.col(own)) & (F.lit(min(others)) <= k)),
    )
    rows = df.withColumn(f"{side}_level", F.explode(wanted))
    at = F.col(f"{side}_level")
    if span[0] == span[1]:
        return rows.withColumn(f"{side}_bucket", _bucket(F.col(span[0]), at))
    both = F.sequence(_bucket(F.col(span[0]), at), _bucket(F.col(span[1]), at))
    return rows.withColumn(f"{side}_bucket", F.explode(both))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_span: Span,
    right_span: Span,
    how: str = "inner",
    hot: dict | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Pairs of equal ``keys`` whose spans have a day in common: all columns of ``left``, then those
    of ``right`` but its keys. A point in time is a span whose two columns are the same; a null
    point meets nothing, nor does a null key. ``how="left"`` keeps points that meet nothing.

    An equi-join: spans are cut into buckets by their length, each span into two at most, and meet in
    the first bucket that both have. Shorter spans go up to the levels that the other side has, so
    a point has a row for each length of span there is, by sixteenths: one to three for histories.
    A key's rows spread over its buckets; ``hot``, as ``skew.hot_keys`` finds it on ``left`` for
    a single key, spreads those of a bucket too. Spans are first cut to the time that both sides have,
    so that open ends are no longer than the data. Over ``FEW_SPANS`` on the right both sides are
    shuffled: Spark takes a side for as large as its files, however many rows it makes of theirs."""
    point = left_span[0] == left_span[1]
    if how not in ("inner", "left") or how == "left" and not point:
        raise ValueError("how is inner, or left for points in time")
    twice = sorted({*left.columns, *right.columns}.intersection(left.columns, right.columns) - set(keys))
    if twice:
        raise ValueError(f"columns on both sides: {', '.join(twice)}")
    a, b = ("_l_start", "_l_start" if point else "_l_end"), ("_r_start", "_r_end")
    one = _bounded(left, left_span, a)
    two = _bounded(right, right_span, b)
    if right_span[0] == right_span[1]:
        two = two.where(F.col(b[0]).isNotNull())
    low, high, sizes = _common_time([(one, a), (two, b)])

    def cut(df: DataFrame, span: Span, level: str) -> DataFrame:
        """The part of each span in common time, counted from its start."""
        begin = F.greatest(F.col(span[0]), F.lit(low)) - low
        end = F.least(F.col(span[1]), F.lit(high)) - low
        inside = F.col(span[0]) <= F.col(span[1])
        ends = {span[0]: begin, span[1]: end} if span[0] != span[1] else {span[0]: F.col(span[0]) - low}
        rows = df.where(inside).withColumns(ends).where(F.col(span[0]).between(0, high - low))
        rows = rows.where((F.col(span[0]) <= F.col(span[1])) & reduce(and_, [F.col(k).isNotNull() for k in keys]))
        length = F.col(span[1]) - F.col(span[0]) + 1
        return rows.withColumn(level, _level(length))

    near, far = cut(one, a, "_l_own"), cut(two, b, "_r_own")
    far_levels = _levels(far, "_r_own")
    near_levels = [0] if point else _levels(near, "_l_own")
    if not far_levels or not near_levels:
        near, far, far_levels, near_levels = near.limit(0), far.limit(0), [0], [0]
    def met(df: DataFrame) -> DataFrame:
        return df.hint("merge") if sizes[1] > FEW_SPANS else df

    renamed = {k: f"_r_key{i}" for i, k in enumerate(keys)}
    far = far.withColumnsRenamed(renamed)
    near = _spread(near, a, "_l_own", far_levels, "_l")
    far = _spread(far, b, "_r_own", near_levels, "_r")
    meet = [F.col(k) == F.col(n) for k, n in renamed.items()]
    meet += [F.col("_l_level") == F.col("_r_level"), F.col("_l_bucket") == F.col("_r_bucket")]
    overlap = F.greatest(a[0], b[0]) <= F.least(a[1], b[1])
    hot = {k: n for k, n in (hot or {}).items() if k is not None}
    if hot and len(keys) == 1:
        ways = _ways(F.col(keys[0]), hot, hot_rows or HOT_ROWS)
        near = near.withColumn("_l_part", F.pmod(F.xxhash64(*left.columns), ways.cast("bigint")).cast("int"))
        back = _ways(F.col(renamed[keys[0]]), hot, hot_rows or HOT_ROWS)
        far = far.withColumn("_r_part", F.explode(F.sequence(F.lit(0), back - 1)))
        meet.append(F.col("_l_part") == F.col("_r_part"))
    # both are spread over two buckets at most: the pair belongs to the one in which the later starts
    first = F.col("_l_bucket") == _bucket(F.greatest(a[0], b[0]), F.col("_l_level"))
    highest = F.col("_l_level") == F.greatest("_l_own", "_r_own")
    taken = [c for c in right.columns if c not in keys]
    pairs = near.join(met(far), reduce(and_, [*meet, overlap, first, highest]))
    pairs = pairs.select(*left.columns, *taken)
    if how == "inner":
        return pairs
    # a point without a partner has none at any level; levels are few
    alone = one.withColumn("_l_start", F.col("_l_start") - low)
    for level in far_levels:
        there = far.where(F.col("_r_level") == level)
        if "_r_part" in far.columns:
            there = there.where("_r_part = 0")
        here = [F.col(k) == F.col(n) for k, n in renamed.items()]
        here += [_bucket(F.col("_l_start"), F.lit(level)) == F.col("_r_bucket")]
        here += [F.col("_l_start").between(F.col("_r_start"), F.col("_r_end"))]
        alone = alone.join(met(there), reduce(and_, here), "left_anti")
    missing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in taken]
    return pairs.unionByName(alone.select(*left.columns, *missing))


def _placed(df: DataFrame, keys: Sequence[str], span: Span) -> DataFrame:
    """Valid spans in order, with the last day before them in their key and whether they start
    apart from all earlier ones."""
    rows = df.select(*keys, *span).withColumns(
        {"_start": F.coalesce(units(df, span[0]), F.lit(PAST)), "_end": F.coalesce(units(df, span[1]), F.lit(FUTURE))}
    )
    rows = in_ranges(rows.where("_start <= _end"), [*keys, "_start", "_end"], "spans")
    rows = with_carry(rows, keys, {"_carried": ("max", F.col("_end"))})
    before = F.greatest(F.max("_end").over(before_in_range(keys)), F.col("_carried"))
    rows = rows.withColumn("_before", before)
    apart = F.col("_before").isNull() | (F.col("_start") > F.col("_before") + 1)
    return rows.withColumn("_apart", apart.cast("bigint")).drop("_carried")


def _named(df: DataFrame, keys: Sequence[str], span: Span, first: Column, last: Column) -> list[Column]:
    kinds = [df.schema[c].dataType for c in span]
    return [*keys, from_units(first, kinds[0]).alias(span[0]), from_units(last, kinds[1]).alias(span[1])]


def merged_spans(df: DataFrame, keys: Sequence[str], span: Span, count: str = "Rows") -> DataFrame:
    """The times in which a key has any span: spans that overlap or follow each other without a gap
    become one, with the number of rows that make it up. Null keys are a key.

    Rows are sorted by ranges of key and time. The latest end so far runs inside a range and is
    carried from range to range, so a key with a third of all rows is spread like any other."""
    rows = settle(_placed(df, keys, span), "placed_spans")
    rows = with_carry(rows, keys, {"_earlier": ("sum", F.col("_apart"))})
    here = F.coalesce(F.sum("_apart").over(before_in_range(keys)), F.lit(0))
    number = F.coalesce("_earlier", F.lit(0)) + here + F.col("_apart")
    islands = rows.withColumn("_number", number).groupBy(*keys, "_number")
    islands = islands.agg(
        F.min("_start").alias("_start"), F.max("_end").alias("_end"), F.count(F.lit(1)).alias(count)
    )
    return islands.select(*_named(df, keys, span, F.col("_start"), F.col("_end")), count)


def span_gaps(df: DataFrame, keys: Sequence[str], span: Span) -> DataFrame:
    """The times between a key's first and last span in which it has none."""
    rows = _placed(df, keys, span).where(F.col("_before").isNotNull() & (F.col("_apart") == 1))
    return rows.select(*_named(df, keys, span, F.col("_before") + 1, F.col("_start") - 1))


def span_overlaps(df: DataFrame, keys: Sequence[str], span: Span) -> DataFrame:
    """Spans that start while an earlier one of their key (by start, then end) is in force, cut to
    the time that both have. One row for each such span, whatever the number of earlier ones."""
    rows = _placed(df, keys, span).where(F.col("_start") <= F.col("_before"))
    return rows.select(*_named(df, keys, span, F.col("_start"), F.least("_end", "_before")))


def empty_spans(df: DataFrame, span: Span) -> DataFrame:
    """Rows whose span ends before it starts."""
    return df.where(F.col(span[1]) < F.col(span[0]))
