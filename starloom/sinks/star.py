"""Loading a whole star in an order that its references allow."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.changes import new_rows
from starloom.plans.schemas import FOREIGN_KEYS, LOOKUP_COLUMNS
from starloom.sinks.files import write_parquet
from starloom.sinks.interleaved import write_interleaved
from starloom.sinks.keymap import KeyMap

Sink = Callable[[str, DataFrame, str], None]


def load_order(tables: Iterable[str], mode: str) -> list[str]:
    """Overwriting replaces referring tables before those they refer to, appending does the
    reverse."""
    tables = list(tables)
    referring = [t for t in tables if t in FOREIGN_KEYS]
    others = [t for t in tables if t not in FOREIGN_KEYS]
    return referring + others if mode == "overwrite" else others + referring


def load_star(
    tables: Mapping[str, DataFrame],
    sink: Sink,
    mode: str = "overwrite",
    keep_tables: bool = False,
) -> None:
    """Call ``sink(name, table, mode)`` for each table in load order.

    ``keep_tables`` is for a sink that empties existing tables with declared references: the
    referring tables are emptied first, then the others are replaced, then they are filled."""
    if mode == "overwrite" and keep_tables:
        for name in load_order(tables, mode):
            if name in FOREIGN_KEYS:
                sink(name, tables[name].limit(0), "overwrite")
        for name in load_order(tables, "append"):
            sink(name, tables[name], "append" if name in FOREIGN_KEYS else "overwrite")
        return
    for name in load_order(tables, mode):
        sink(name, tables[name], mode)


class ParquetSink:
    """One folder per table under ``root``, sorted by the columns readers look up. What it
    wrote can be read back, so that reports need no other copy.

    ``partition_by`` names columns made of the fact's DateKey, ``Year`` or ``Year`` and
    ``Month``: each value is a folder, so that a filter on them opens only its files. Rows go to
    tasks by these columns and a hash of the row, ``files`` to a folder at most.

    ``interleave`` writes each table that is overwritten in that many files of ranges of all its
    lookup columns at once, see ``interleaved``: ``read_interleaved`` then opens only the files that a
    filter on any of them needs."""

    def __init__(
        self,
        root: str,
        sort: bool = True,
        partition_by: Sequence[str] = (),
        files: int = 4,
        interleave: int = 0,
    ):
        if interleave and partition_by:
            raise ValueError("files are interleaved or in folders by date, not both")
        self.root, self.sort, self.interleave = root, sort, interleave
        self.partition_by, self.files = list(partition_by), files
        self.keys = KeyMap(f"{root}/_keys")

    def __call__(self, name: str, df: DataFrame, mode: str) -> None:
        columns = LOOKUP_COLUMNS.get(name, []) if self.sort else []
        sort_by = [c for c in columns if c in df.columns]
        folders: list[str] = []
        if self.interleave and sort_by:
            if mode != "overwrite":
                raise ValueError("interleaved tables are overwritten: their files hold ranges of all rows")
            write_interleaved(df, f"{self.root}/{name}", sort_by, self.interleave)
            return
        if name in FOREIGN_KEYS and self.partition_by:
            parts = {"Year": F.col("DateKey") / 10000, "Month": F.col("DateKey") / 100 % 100}
            folders = self.partition_by
            df = df.withColumns({c: F.floor(parts[c]).cast("int") for c in folders})
            spread = F.pmod(F.xxhash64(*df.columns), F.lit(self.files))
            df = df.repartition(*[F.col(c) for c in folders], spread)
        write_parquet(df, f"{self.root}/{name}", mode, folders, sort_by)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{name}")

    def new_rows(self, name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Rows of ``df`` whose key the written table does not hold."""
        written = KeyMap(self.root).read(df.sparkSession, name)
        return df if written is None else new_rows(df, written, keys)


def save_tables(tables: Mapping[str, DataFrame], root: str, database: str) -> None:
    """Drop and recreate the tables of a catalog database, fact first, their files under
    ``root``."""
    spark = next(iter(tables.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root}'")
    for name in load_order(tables, "overwrite"):
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    for name in load_order(tables, "overwrite"):
        writer = tables[name].write.mode("overwrite").option("path", f"{root}/{name}")
        writer.saveAsTable(f"`{database}`.`{name}`")
