"""Keyed changes, XML columns and sparse column sets."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    op: str = "op",
    order: Sequence[str] = (),
) -> DataFrame:
    """The target after one change per key: ``I`` adds a row where the key is new, ``U`` replaces
    the row and ``D`` removes it where the key exists. A change that does not apply has no
    effect. Of several changes of one key the last by the ``order`` columns counts; without
    ``order`` they raise. The target must be unique on ``keys``; each side is shuffled once."""
    row = F.struct(*changes.columns)
    if order:
        one = F.max_by(row, F.struct(*order))
    else:
        several = F.raise_error(F.lit("several changes of one key, and no order given"))
        one = F.when(F.count("*") == 1, F.first(row)).otherwise(several)
    changes = changes.groupBy(*keys).agg(one.alias("_change")).select("_change.*")
    old = target.select(F.lit(True).alias("_old"), F.struct(*target.columns).alias("_was"), *keys)
    new = changes.select(
        F.col(op).alias("_op"), F.struct(*target.columns).alias("_will"), *keys
    )
    both = old.alias("t").join(
        new.alias("c"), reduce(and_, [F.col(f"t.{k}") == F.col(f"c.{k}") for k in keys]), "full"
    )
    exists = F.col("_old").isNotNull()
    change = F.coalesce("_op", F.lit("none"))
    row = F.when(exists & (change != "U"), F.col("_was")).otherwise(F.col("_will"))
    stays = F.when(exists, change != "D").otherwise(change == "I")
    return both.where(stays).select(row.alias("_row")).select("_row.*")


def new_rows(df: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key ``held`` does not have: what an append may add."""
    return df.join(held.select(*keys), list(keys), "left_anti").select(*df.columns)


def sparse_set(df: DataFrame, columns: Sequence[str], name: str = "ColumnSet") -> DataFrame:
    """Replace mostly empty columns by one map of those that have a value, as text."""
    pairs = chain.from_iterable((F.lit(c), F.col(c).cast("string")) for c in columns)
    present = F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
    return df.select(*[c for c in df.columns if c not in set(columns)], present.alias(name))


def xml_fields(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Replace an XML text column by the fields of ``schema`` (a DDL string)."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.from_xml(column, schema).alias("_xml")).select(*rest, "_xml.*")


def xml_values(df: DataFrame, column: str, paths: Mapping[str, str]) -> DataFrame:
    """Add the text at one path per result column; null where the path is absent.

    A text that is not empty is there; whether an empty one is takes a second look, but for paths that
    may compute a value. Documents are dealt out first: parsing is much more work than
    reading, and a small file is read by one task."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = {}
    for name, path in paths.items():
        found, there = F.xpath_string(column, F.lit(path)), F.xpath_boolean(column, F.lit(path))
        plain = re.fullmatch(r"/[\w./@:]+", path)
        out[name] = F.when(found != "", found).when(there, found) if plain else F.when(there, found)
    return df.repartition(tasks).withColumns(out)
