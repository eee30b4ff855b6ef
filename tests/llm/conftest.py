"""Helpers for the tests of the training-data operators; the session comes from tests/conftest.py."""

from collections import Counter

import duckdb
import pytest

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


@pytest.fixture
def same_rows(duck):
    """Compares a DataFrame with SQL by column name and value; doubles to 12 digits."""

    def norm(value):
        return float(f"{value:.12g}") if isinstance(value, float) else value

    def rows(columns, data):
        order = sorted(range(len(columns)), key=lambda i: columns[i])
        return Counter(tuple(norm(row[i]) for i in order) for row in data)

    def check(df, sql):
        expected = duck.sql(sql)
        assert sorted(df.columns) == sorted(expected.columns)
        got, want = rows(df.columns, df.collect()), rows(expected.columns, expected.fetchall())
        assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])

    return check
