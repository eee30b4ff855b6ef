"""Types of columns that come as text, from their values: a lattice, one pass, mergeable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: From narrow to wide. Numbers widen to the right, days to times; what fits neither is text.
NUMBERS, TIMES = ("bit", "int", "bigint", "decimal"), ("date", "timestamp")
TYPES = (*NUMBERS, *TIMES)
#: Digits of the widest decimal.
PRECISION = 38
_WHOLE = r"^-?(0|[1-9][0-9]*)$"
_DECIMAL = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?$"


def _digits(value: Column) -> Column:
    """Digits before the point."""
    return F.length(F.regexp_extract(value, r"^-?([0-9]+)", 1))


def _scale(value: Column) -> Column:
    """Digits behind the point."""
    return F.length(F.regexp_extract(value, r"\.([0-9]+)$", 1))


def fits(value: Column, kind: str) -> Column:
    """Whether a text reads as that type and back: a number with zeros before it, a plus sign or an
    exponent is text, as is a day that no calendar has."""
    if kind == "bit":
        return value.isin("0", "1")
    if kind in ("int", "bigint"):
        return value.rlike(_WHOLE) & value.try_cast(kind).isNotNull()
    if kind == "decimal":
        return value.rlike(_DECIMAL) & (_digits(value) + _scale(value) <= PRECISION)
    if kind == "date":
        return value.rlike(_DATE) & value.try_cast("date").isNotNull()
    if kind == "timestamp":
        return (value.rlike(_TIME) | value.rlike(_DATE)) & value.try_cast("timestamp_ntz").isNotNull()
    raise ValueError(f"{kind} is none of {', '.join(TYPES)}")


def _with_facts(cells: DataFrame) -> DataFrame:
    """Of each ``_value``, in few looks at it: its length, whether it reads as a decimal, the digits
    before and behind the point then, and whether it has the form of a day or time. Texts of other lengths
    are none; of a decimal nothing but the point tells a whole number. ``$`` lets one line break follow."""
    value, size, decimal = F.col("_value"), F.col("_size"), F.col("_decimal")
    cells = cells.withColumns({"_size": F.length(value), "_decimal": F.coalesce(value.rlike(_DECIMAL), F.lit(False))})
    plain = F.when(decimal, F.rtrim(value, F.lit("\r\n\u0085\u2028\u2029")))
    form = F.when(size.between(10, 12), value.rlike(_DATE)).when(size.between(19, 31), value.rlike(_TIME))
    form = F.when(decimal, False).otherwise(F.coalesce(form, F.lit(False)))
    cells = cells.withColumns({"_plain": F.length(plain), "_point": F.when(decimal, F.instr(value, ".")), "_form": form})
    plain, point = F.col("_plain"), F.col("_point")
    sign = F.when(value.startswith("-"), 1).otherwise(0)
    digits = F.when(point > 0, point - 1).otherwise(plain) - sign
    scale = F.when(point > 0, plain - point).otherwise(F.when(decimal, 0))
    return cells.withColumns({"_digits": F.when(decimal, digits), "_scale": scale})


def _fits(kind: str) -> Column:
    """``fits`` from the facts of a text."""
    value, size = F.col("_value"), F.col("_size")
    if kind == "bit":
        return value.isin("0", "1")
    if kind in ("int", "bigint"):
        always = 9 if kind == "int" else 18  # so many characters are never too many
        whole = F.col("_decimal") & (F.col("_scale") == 0)
        return whole & F.when(size <= always, True).otherwise(value.try_cast(kind).isNotNull())
    if kind == "decimal":
        return F.col("_decimal") & (F.col("_digits") + F.col("_scale") <= PRECISION)
    days = F.col("_form") & (size <= 12) if kind == "date" else F.col("_form")
    return F.when(days, value.try_cast("date" if kind == "date" else "timestamp_ntz").isNotNull()).otherwise(False)


def type_state(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per text column: ColumnName, Rows, Empty (null or empty), Longest (characters), Digits and
    Scale (the most before and behind a point), and for each type the values that do not fit it.

    Counts and maxima only, so states of files or loads merge; rows of one column are folded
    inside each task."""
    names = list(columns) if columns is not None else df.columns
    entries = F.array(
        *[F.struct(F.lit(n).alias("ColumnName"), F.col(f"`{n}`").cast("string").alias("Value")) for n in names]
    )
    cells = df.select(F.explode(entries).alias("c")).select("c.*")
    cells = cells.select("ColumnName", F.nullif("Value", F.lit("")).alias("_value"))
    cells = _with_facts(cells).select("ColumnName", "_value", "_size", "_digits", "_scale", *[_fits(t).alias(f"_{t}") for t in TYPES])
    known = F.col("_value").isNotNull()
    return cells.groupBy("ColumnName").agg(
        F.count(F.lit(1)).alias("Rows"), F.count_if(~known).alias("Empty"),
        F.coalesce(F.max("_size"), F.lit(0)).cast("bigint").alias("Longest"),
        F.coalesce(F.max(F.when(F.col("_decimal"), F.col("_digits"))), F.lit(0)).cast("bigint").alias("Digits"),
        F.coalesce(F.max(F.when(F.col("_decimal"), F.col("_scale"))), F.lit(0)).cast("bigint").alias("Scale"),
        *[F.count_if(known & ~F.coalesce(F.col(f"_{t}"), F.lit(False))).alias(f"Not_{t}") for t in TYPES],
    )


def merged_state(states: DataFrame) -> DataFrame:
    """One row per column from the states of several parts, in any order."""
    return states.groupBy("ColumnName").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("Rows", "Empty")],
        *[F.max(c).alias(c) for c in ("Longest", "Digits", "Scale")],
        *[F.sum(f"Not_{t}").cast("bigint").alias(f"Not_{t}") for t in TYPES],
    )


def inferred_types(state: DataFrame) -> DataFrame:
    """ColumnName, Type and what breaks the next narrower one: the narrowest type that all values fit,
    ``null`` without any, and Breaks, the values that keep the column from the type that most fit.

    A decimal is as wide as its widest integer part and its longest fraction together."""
    known = F.col("Rows") > F.col("Empty")
    precision = F.col("Digits") + F.col("Scale")
    decimal = F.concat(F.lit("decimal("), precision.cast("string"), F.lit(","), F.col("Scale").cast("string"), F.lit(")"))
    kind = F.when(~known, "null")
    for t in TYPES:
        said = decimal if t == "decimal" else F.lit(t)
        wide = (precision <= PRECISION) if t == "decimal" else F.lit(True)
        kind = kind.when((F.col(f"Not_{t}") == 0) & wide, said)
    kind = kind.otherwise(F.concat(F.lit("varchar("), F.col("Longest").cast("string"), F.lit(")")))
    # of the types that are narrower than the column's own, the one that fewest values break
    fewest = F.least(*[F.when(F.col(f"Not_{t}") > 0, F.col(f"Not_{t}")) for t in TYPES])
    values = F.col("Rows") - F.col("Empty")
    breaks = F.when(known & (fewest < values), fewest).otherwise(0).cast("bigint")
    return state.select("ColumnName", kind.alias("Type"), "Rows", "Empty", "Longest", breaks.alias("Breaks"))


def breaking_rows(df: DataFrame, column: str, kind: str) -> DataFrame:
    """Rows whose text is not empty and does not fit the type."""
    value = F.col(f"`{column}`").cast("string")
    return df.where((value != "") & ~F.coalesce(fits(value, kind), F.lit(False)))
