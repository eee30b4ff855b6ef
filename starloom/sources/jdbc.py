"""Database tables, read in parallel."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# The tables the two stars are built from, by the names used in ``plans.star``.
SOURCE_TABLES = {
    "Customer": "Sales.Customer",
    "Person": "Person.Person",
    "PersonPhone": "Person.PersonPhone",
    "EmailAddress": "Person.EmailAddress",
    "Product": "Production.Product",
    "ProductSubcategory": "Production.ProductSubcategory",
    "ProductCategory": "Production.ProductCategory",
    "Address": "Person.Address",
    "StateProvince": "Person.StateProvince",
    "CountryRegion": "Person.CountryRegion",
    "SalesOrderHeader": "Sales.SalesOrderHeader",
    "SalesOrderDetail": "Sales.SalesOrderDetail",
}
# Integer columns by which large tables are cut for reading.
PARTITION_COLUMNS = {
    "Customer": "CustomerID",
    "Person": "BusinessEntityID",
    "PersonPhone": "BusinessEntityID",
    "EmailAddress": "BusinessEntityID",
    "Product": "ProductID",
    "Address": "AddressID",
    "SalesOrderHeader": "SalesOrderID",
    "SalesOrderDetail": "SalesOrderID",
}


def connection(role: str, environ: Mapping[str, str] | None = None) -> tuple[str, dict[str, str]]:
    """``(url, properties)`` of the ``SOURCE`` or ``TARGET`` database, from the environment:
    ``<ROLE>_JDBC_URL``, ``_USER``, ``_PASSWORD`` and optionally ``_DRIVER``, ``_STRINGTYPE``."""
    environ = os.environ if environ is None else environ
    prefix = f"{role.upper()}_JDBC_"
    properties = {
        option: environ[prefix + option.upper()]
        for option in ("user", "password", "driver", "stringtype")
        if prefix + option.upper() in environ
    }
    return environ[prefix + "URL"], properties


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    part_col: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 8,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """A table or parenthesised query, cut into ``partitions`` ranges of ``part_col``.

    Missing bounds are asked from the database. They only place the cuts: rows outside them
    fall into the first or last partition. Without ``part_col`` the scan has one partition."""
    properties = {**properties, "fetchsize": str(fetch_rows)}
    if part_col is None:
        return spark.read.jdbc(url, table, properties=properties)
    if lower is None or upper is None:
        ends = f"(SELECT MIN({part_col}) AS lo, MAX({part_col}) AS hi FROM {table}) ends"
        low, high = spark.read.jdbc(url, ends, properties=properties).first()
        lower = (0 if low is None else low) if lower is None else lower
        upper = (lower + 1 if high is None else high) if upper is None else upper
    return spark.read.jdbc(
        url,
        table,
        column=part_col,
        lowerBound=lower,
        upperBound=max(upper, lower + 1),
        numPartitions=partitions,
        properties=properties,
    )


def jdbc_source(spark: SparkSession, role: str = "SOURCE", partitions: int = 8):
    """``source(name)`` for ``plans.star.run_warehouse``: reads one of ``SOURCE_TABLES``."""
    url, properties = connection(role)

    def source(name: str) -> DataFrame:
        part_col = PARTITION_COLUMNS.get(name)
        table = SOURCE_TABLES[name]
        return read_jdbc(spark, url, table, properties, part_col, partitions=partitions)

    return source
