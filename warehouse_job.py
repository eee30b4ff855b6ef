"""Run the warehouse with spark-submit.

    warehouse_job.py preview --tables DIR            schema and first rows of each source table
    warehouse_job.py build --tables DIR --out DIR    star as Parquet, reports as CSV
    warehouse_job.py load --tables DIR --out DIR     star into the TARGET database, reports as CSV

Without --tables the source tables are read from the SOURCE database. Both databases are named
by environment variables, see ``starloom.sources.jdbc.connection``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starloom.operators.shape import inspect
from starloom.plans.schemas import FACT, PRIMARY_KEYS
from starloom.plans.star import Source, run_warehouse, staged
from starloom.settings import cluster_conf
from starloom.sinks import AtomicStore, JdbcSink, ParquetSink, write_csv, write_parquet
from starloom.sinks.keymap import KeyMap
from starloom.sources.jdbc import SOURCE_TABLES, connection, jdbc_source
from starloom.sources.retail import retail_source
from starloom.staging import clear


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=["preview", "build", "load"])
    parser.add_argument("--tables", help="folder of Parquet tables; else the SOURCE database")
    parser.add_argument("--out", help="folder for the star and its reports")
    parser.add_argument("--model", choices=["wide", "narrow"], default="wide")
    parser.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    parser.add_argument("--ids", choices=["int", "bigint"], default="int")
    parser.add_argument("--rows", type=int, default=5, help="rows to preview")
    parser.add_argument("--connections", type=int, default=8)
    parser.add_argument("--cores", type=int, default=64, help="executor cores in all")
    parser.add_argument("--input-gb", type=float, default=0, help="size of the source tables")
    parser.add_argument("--partition-by", nargs="*", choices=["Year", "Month"], default=[])
    parser.add_argument("--atomic", action="store_true", help="build: all tables appear at once")
    parser.add_argument("--keep-tables", action="store_true", help="empty instead of drop")
    args = parser.parse_args(argv)
    if args.job != "preview" and not args.out:
        parser.error(f"{args.job} needs --out")
    if args.atomic and (args.job != "build" or args.partition_by):
        parser.error("--atomic is for a build without --partition-by")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    source: Source
    if args.tables:
        source = retail_source(spark, args.tables)
    else:
        source = jdbc_source(spark, partitions=args.connections)
    if args.job == "preview":
        for name in SOURCE_TABLES:
            print(name)
            inspect(source(name), args.rows)
        return
    keys: KeyMap | None = KeyMap(f"{args.out}/{args.model}/_keys")
    if args.job == "build" and args.atomic:
        sink, keys = AtomicStore(f"{args.out}/{args.model}").begin(spark), None  # it has its own
    elif args.job == "build":
        sink = ParquetSink(f"{args.out}/{args.model}", partition_by=args.partition_by)
    else:
        primary = PRIMARY_KEYS
        if args.model == "wide":
            primary = {**primary, FACT: ["SalesOrderID", "SalesOrderDetailID"]}
        else:  # lines of the narrow fact have no key of their own: the key map tells new ones
            primary = {name: key for name, key in primary.items() if name != FACT}
        url, properties = connection("TARGET")
        sink = JdbcSink(
            url, properties, primary, connections=args.connections, keep_tables=args.keep_tables
        )
    run_warehouse(
        source if args.tables else staged(source),
        sink,
        args.model,
        lambda name, df: write_csv(df, f"{args.out}/aggregations/{name}"),
        args.mode,
        args.ids,
        keys,
        lambda name, df: write_parquet(df, f"{args.out}/rejects/{name}"),
    )


def main() -> None:
    args = arguments()
    builder = SparkSession.builder.appName("warehouse")
    for name, value in cluster_conf(args.cores, int(args.input_gb * 1e9)).items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    try:
        run(session, args)
    finally:
        clear(session)
        session.stop()


if __name__ == "__main__":
    main()
