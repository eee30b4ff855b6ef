"""Database sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.changes import new_rows
from starloom.plans.schemas import MAX_LENGTHS
from starloom.sources.jdbc import read_jdbc


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    mode: str = "overwrite",
    connections: int = 8,
    batch_rows: int = 10_000,
    keep_table: bool = False,
    column_types: str | None = None,
) -> None:
    """Write to a database table over at most ``connections`` connections.

    Overwriting drops the table and creates it, with ``column_types`` where given. With
    ``keep_table`` it is emptied instead, and tables that refer to it are emptied too, so that
    keys and indexes stay; see ``star.load_star``."""
    options = {
        "numPartitions": str(connections),
        "batchsize": str(batch_rows),
        "truncate": str(keep_table).lower(),
        "cascadeTruncate": str(keep_table).lower(),
    }
    if column_types and mode == "overwrite" and not keep_table:
        options["createTableColumnTypes"] = column_types
    df.write.jdbc(url, table, mode=mode, properties={**properties, **options})


def append_new_rows(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    keys: Sequence[str],
    connections: int = 8,
) -> None:
    """Append the rows whose key the table does not hold yet, so that a second run adds none."""
    columns = ", ".join(f'"{k}"' for k in keys)
    part_col = f'"{keys[0]}"' if isinstance(df.schema[keys[0]].dataType, T.IntegralType) else None
    held = read_jdbc(
        df.sparkSession,
        url,
        f"(SELECT {columns} FROM {table}) held",
        properties,
        part_col,
        partitions=connections,
    )
    held = held.select(*[F.col(c).alias(k) for c, k in zip(held.columns, keys)])
    write_jdbc(new_rows(df, held, keys), url, table, properties, "append", connections)


class JdbcSink:
    """Star tables to a database, under quoted names in ``schema``. Appending adds only rows
    whose ``keys`` the table does not hold. Text columns get their declared lengths."""

    def __init__(
        self,
        url: str,
        properties: Mapping[str, str],
        keys: Mapping[str, Sequence[str]],
        schema: str = "public",
        connections: int = 8,
        keep_tables: bool = False,
    ):
        self.url, self.properties, self.keys = url, properties, keys
        self.schema, self.connections, self.keep_tables = schema, connections, keep_tables

    def __call__(self, name: str, df: DataFrame, mode: str) -> None:
        table = f'{self.schema}."{name}"'
        to = (self.url, table, self.properties)
        if mode == "append" and name in self.keys:
            append_new_rows(df, *to, self.keys[name], self.connections)
            return
        limits = MAX_LENGTHS.get(name, {})
        types = ", ".join(f"{c} VARCHAR({limits[c]})" for c in df.columns if c in limits)
        write_jdbc(
            df,
            *to,
            mode,
            self.connections,
            keep_table=self.keep_tables,
            column_types=types or None,
        )
