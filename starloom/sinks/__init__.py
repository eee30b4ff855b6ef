from starloom.sinks.atomic import AtomicStore
from starloom.sinks.files import write_csv, write_parquet
from starloom.sinks.jdbc import JdbcSink, append_new_rows, write_jdbc
from starloom.sinks.star import ParquetSink, load_order, load_star, save_tables

__all__ = [
    "AtomicStore",
    "JdbcSink",
    "ParquetSink",
    "append_new_rows",
    "load_order",
    "load_star",
    "save_tables",
    "write_csv",
    "write_jdbc",
    "write_parquet",
]
