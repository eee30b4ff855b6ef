"""Parquet whose files can be skipped by a filter on any of several columns."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a column's place in the key, and rows that are looked at to cut a column into as many parts.
BITS, SAMPLE = 6, 20_000
#: Beside the files, where readers of the folder do not look.
MANIFEST = "_files"


def _cuts(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """For each column up to 2**BITS - 1 values that part it into about equal numbers of rows.

    From a sample of bounded size: it steers which rows lie together, not what is read."""
    rows = df.select(*columns)
    fraction = min(1.0, SAMPLE / max(rows.count(), 1))
    if fraction < 1:
        rows = rows.sample(fraction, seed=11)
    found = rows.limit(2 * SAMPLE).collect()
    out = {}
    for column in columns:
        values = sorted(r[column] for r in found if r[column] is not None)
        wanted = [values[len(values) * k // (1 << BITS)] for k in range(1, 1 << BITS)] if values else []
        # one cut a value: a value with many rows is a part of its own
        out[column] = [v for k, v in enumerate(wanted) if bisect_left(wanted, v) == k]
    return out


def interleaved_key(cuts: Mapping[str, Sequence], kinds: Mapping[str, str]) -> Column:
    """A number whose bits are those of the columns' parts in turn, the highest first: rows near each
    other by it are near in every column. Nulls are in the first part."""
    key = F.lit(0).cast("bigint")
    parts = []

    def part_of(value: Column, literals: Column) -> Column:
        return F.size(F.filter(literals, lambda cut: cut <= value))

    for column, values in cuts.items():
        literals = F.array(*[F.lit(v).cast(kinds[column]) for v in values]).cast(f"array<{kinds[column]}>")
        part = part_of(F.col(column), literals) if values else F.lit(0)
        parts.append(F.coalesce(part, F.lit(0)).cast("bigint"))
    for bit in reversed(range(BITS)):
        for part in parts:
            key = key * 2 + F.shiftright(part, bit).bitwiseAND(F.lit(1))
    return key


def write_interleaved(df: DataFrame, path: str, columns: Sequence[str], files: int) -> None:
    """Writes ``df`` in about ``files`` files of ranges of the interleaved key of ``columns``, and a
    manifest with each file's rows and the least and greatest value of each column.

    A filter on one of n columns opens about ``files ** (1 - 1/n)`` files instead of all. One
    shuffle; equal rows of one key go on to further files, so no value makes a large one."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in columns}
    key = interleaved_key(_cuts(df, columns), kinds)
    rows = df.withColumns({"_key": key, "_tie": F.xxhash64(*df.columns)})
    rows = rows.repartitionByRange(files, "_key", "_tie").sortWithinPartitions("_key")
    rows.drop("_key", "_tie").write.mode("overwrite").parquet(path)
    _write_manifest(df.sparkSession, path, columns, df.schema)


def _write_manifest(spark: SparkSession, path: str, columns: Sequence[str], schema) -> None:
    written = spark.read.schema(schema).parquet(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    least = [F.min(c).alias(f"min_{c}") for c in columns]
    most = [F.max(c).alias(f"max_{c}") for c in columns]
    found = written.groupBy(name.alias("file")).agg(F.count(F.lit(1)).alias("rows"), *least, *most)
    found.coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}")


def files_for(spark: SparkSession, path: str, ranges: Mapping[str, tuple]) -> list[str]:
    """Names of the files that may hold rows with every column in its range, (least, greatest) or None
    for no limit. The manifest has a row a file, and only those that fit are collected."""
    fits = F.lit(True)
    for column, (low, high) in ranges.items():
        if low is not None:
            fits &= F.col(f"max_{column}") >= F.lit(low)
        if high is not None:
            fits &= F.col(f"min_{column}") <= F.lit(high)
    manifest = spark.read.parquet(f"{path}/{MANIFEST}")
    return sorted(r["file"] for r in manifest.where(fits).select("file").collect())


def read_interleaved(spark: SparkSession, path: str, ranges: Mapping[str, tuple]) -> DataFrame:
    """The rows with every column in its range, from the files that may hold any; no others are
    opened. Without ranges all rows."""
    whole = spark.read.parquet(path)
    names = files_for(spark, path, ranges)
    rows = spark.read.schema(whole.schema).parquet(*[f"{path}/{n}" for n in names]) if names else whole.limit(0)
    for column, (low, high) in ranges.items():
        if low is not None:
            rows = rows.where(F.col(column) >= F.lit(low))
        if high is not None:
            rows = rows.where(F.col(column) <= F.lit(high))
    return rows
