"""Registered queries with a SQL counterpart, whole tables, value by value."""

import pytest
from starloom.llm.queries import QUERIES
from starloom.llm.sql import SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, folder, same_rows, name):
    same_rows(QUERIES[name](spark, folder), SQL[name])
