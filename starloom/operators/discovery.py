"""What tables say about their own keys and references, found without rules."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.staging import settle

_WHOLE, _REAL, _TIME = "number", "real", "time"


def _value(df: DataFrame, column: str) -> tuple[str, str, Column]:
    """The kind of values a column has, the field that holds them, and a value that is equal where
    values are equal: whole numbers and decimals of any width are one kind, as are days and times."""
    kind = df.schema[column].dataType
    name = F.col(f"`{column}`")
    if isinstance(kind, T.IntegralType):
        return _WHOLE, "whole", name.cast("bigint")
    if isinstance(kind, T.DecimalType):
        plain = F.regexp_replace(name.cast("decimal(38,10)").cast("string"), r"\.?0+$", "")
        return _WHOLE, "text", F.when(plain.isin("", "-", "-0"), "0").otherwise(plain)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _REAL, "real", name.cast("double") + 0.0
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return _TIME, "whole", F.unix_micros(name.cast("timestamp"))
    if isinstance(kind, T.StringType):
        return "text", "text", name
    if isinstance(kind, T.BooleanType):
        return "flag", "text", name.cast("string")
    raise TypeError(f"{column}: values of {kind.simpleString()} are not compared")


#: Fields that hold values before they are texts.
_FIELDS = {"whole": "bigint", "real": "double", "text": "string"}


def _as_text() -> Column:
    time = F.date_format(F.timestamp_micros("whole"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    whole = F.when(F.col("Kind") == _TIME, time).otherwise(F.col("whole").cast("string"))
    return F.coalesce(whole, F.col("real").cast("string"), "text")


def comparable(df: DataFrame) -> list[str]:
    """Columns whose values can be compared; arrays, maps, structs and binaries are left out."""
    out = []
    for f in df.schema.fields:
        try:
            _value(df, f.name)
        except TypeError:
            continue
        out.append(f.name)
    return out


def column_values(tables: Mapping[str, DataFrame], name: str = "column_values") -> DataFrame:
    """(Kind, Value, Columns): for every value of any column the columns that have it, each with its
    number of rows; written. ``Columns`` has a field for each column of all tables at most.

    One pass over every table. A column's values are counted as they are inside each task before they
    are shuffled, so a value with a third of all rows is one row a task; they become texts once a
    value, not once a row, and meet by value. Nulls are counted by ``candidate_keys``."""
    parts, names = [], []
    for table, df in tables.items():
        entries = []
        for column in comparable(df):
            kind, field, value = _value(df, column)
            fields = [(value if f == field else F.lit(None).cast(t)).alias(f) for f, t in _FIELDS.items()]
            entries.append(F.struct(F.lit(len(names)).alias("at"), *fields))
            names.append((f"{table}.{column}", kind))
        if entries:
            parts.append(df.select(F.explode(F.array(*entries)).alias("v")).select("v.*"))
    rows = reduce(DataFrame.unionByName, parts).where(reduce(or_, [F.col(f).isNotNull() for f in _FIELDS]))
    counted = rows.groupBy("at", *_FIELDS).agg(F.count(F.lit(1)).alias("Rows"))
    named = [F.array(*[F.lit(x[k]) for x in names])[F.col("at")].alias(n) for k, n in enumerate(("Column", "Kind"))]
    texts = counted.select(*named, *_FIELDS, "Rows").select("Column", "Kind", _as_text().alias("Value"), "Rows")
    # two times may be one text, where clocks go back; values meet once for that and for other columns
    rows = texts.repartition("Kind", "Value").groupBy("Kind", "Value", "Column").agg(F.sum("Rows").alias("Rows"))
    found = rows.groupBy("Kind", "Value").agg(
        F.collect_list(F.struct("Column", "Rows")).alias("Columns")
    )
    return settle(found, name)


def candidate_keys(values: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: TableName, ColumnName, Rows, Nulls, Values, Repeated (values that occur more
    than once), IsKey (no null, nothing repeated, and not an empty table)."""
    per_value = values.select(F.explode("Columns").alias("c")).groupBy("c.Column").agg(
        F.count(F.lit(1)).alias("Values"), F.count_if(F.col("c.Rows") > 1).alias("Repeated"),
        F.sum("c.Rows").alias("Known"),
    )
    names = [(t, c, f"{t}.{c}") for t, df in tables.items() for c in comparable(df)]
    spark = values.sparkSession
    sizes = [df.agg(F.lit(t).alias("TableName"), F.count(F.lit(1)).alias("Rows")) for t, df in tables.items()]
    listed = spark.createDataFrame(names, "TableName string, ColumnName string, Column string")
    listed = listed.join(reduce(DataFrame.unionByName, sizes), "TableName").join(per_value, "Column", "left")
    zero = F.lit(0).cast("bigint")
    distinct, again, known = (F.coalesce(c, zero) for c in ("Values", "Repeated", "Known"))
    return listed.select(
        "TableName", "ColumnName", "Rows", (F.col("Rows") - known).alias("Nulls"), distinct.alias("Values"),
        again.alias("Repeated"),
        ((F.col("Rows") > 0) & (F.col("Rows") == known) & (again == 0)).alias("IsKey"),
    )


def inclusions(values: DataFrame, least_share: float = 1.0) -> DataFrame:
    """Pairs of columns (ChildColumn, ParentColumn) where the parent has at least ``least_share`` of the child's
    values: Values and Shared, distinct, and ChildRows and SharedRows, the child's rows with such a value.

    Values that the same columns have are counted together first, so pairs are made of sets of columns,
    never of values, rows or tables. A column without values is in no pair.
    """
    each = values.select(
        F.array_sort(F.transform("Columns", lambda c: c["Column"])).alias("Together"),
        F.explode("Columns").alias("child"),
    )
    sets = each.groupBy(F.col("child.Column").alias("ChildColumn"), "Together").agg(
        F.count(F.lit(1)).alias("n"), F.sum("child.Rows").alias("r")
    )
    whole = sets.groupBy("ChildColumn").agg(F.sum("n").alias("Values"), F.sum("r").alias("ChildRows"))
    pairs = sets.select("ChildColumn", F.explode("Together").alias("ParentColumn"), "n", "r")
    shared = pairs.where(F.col("ChildColumn") != F.col("ParentColumn")).groupBy(
        "ChildColumn", "ParentColumn"
    ).agg(F.sum("n").alias("Shared"), F.sum("r").alias("SharedRows"))
    found = shared.join(whole, "ChildColumn")
    return found.where(F.col("Shared") >= F.col("Values") * F.lit(float(least_share))).select(
        "ChildColumn", "ParentColumn", "Values", "Shared", "ChildRows", "SharedRows"
    )


def references(values: DataFrame, tables: Mapping[str, DataFrame], least_share: float = 1.0) -> DataFrame:
    """The inclusions whose parent is a candidate key of another table: foreign keys that hold, or
    nearly hold, with the rows that break them."""
    keys = candidate_keys(values, tables).where("IsKey")
    parents = keys.select(F.concat_ws(".", "TableName", "ColumnName").alias("ParentColumn"))
    table = lambda c: F.substring_index(c, ".", 1)
    found = inclusions(values, least_share).join(parents, "ParentColumn")
    found = found.where(table(F.col("ChildColumn")) != table(F.col("ParentColumn")))
    broken = (F.col("ChildRows") - F.col("SharedRows")).alias("BrokenRows")
    return found.select("ChildColumn", "ParentColumn", "Values", "Shared", broken)
