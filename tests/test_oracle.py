"""Every registered query against the same question in SQL, whole tables, value by value."""

from collections import Counter
from decimal import Decimal
import math
import os

import duckdb
import pytest
from retail_oracle import SQL
from retail_queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def kind(type_name: str) -> str:
    """Type families that both engines share; decimals keep their scale."""
    name = type_name.lower()
    if name.startswith("decimal"):
        return "decimal," + name.rstrip(")").split(",")[1]
    families = {
        "string": "text", "varchar": "text", "boolean": "bool", "date": "date", "double": "double",
        "tinyint": "int8", "smallint": "int16", "int": "int32", "integer": "int32",
        "bigint": "int64", "timestamp_ntz": "ts", "timestamp": "ts",
    }
    return families[name]


def norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, Decimal):
        return str(value.normalize())
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    expected = duck.sql(SQL[name])
    types = {f.name: kind(f.dataType.simpleString()) for f in result.schema.fields}
    expected_types = {c: kind(str(t)) for c, t in zip(expected.columns, expected.types)}
    assert types == expected_types
    got = rows(result.columns, result.collect())
    want = rows(expected.columns, expected.fetchall())
    assert sum(want.values()) > 0 or name.startswith("audit")
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
