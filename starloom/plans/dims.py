"""Dimension builders. Inputs are source tables, outputs follow ``schemas``.

Keys are assigned on the source table before any lookup: lookups are one-to-one, so the
numbers are the same, and counting ranges reads one column instead of running the joins.
Narrow builders keep the natural key (first column after the surrogate) for the fact build;
``schemas`` leaves it out, so conforming drops it. ``held`` are the keys an earlier load
gave, see ``keys.stable_key``. Calling a builder runs jobs: keys are counted and small lookups
are written.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import calendar_columns, customer_type, date_key, fiscal_columns, full_name
from starloom.operators.keys import ROWS_PER_RANGE, stable_key
from starloom.operators.lookup import lookup
from starloom.operators.shape import conform, first_match, require_not_null
from starloom.operators.skew import hot_keys, spread_join
from starloom.plans.schemas import REQUIRED, table_schema
from starloom.staging import settle


def _finish(df: DataFrame, table: str, ids: str, clean: bool) -> DataFrame:
    out = conform(df, table_schema("wide", table, ids))
    return require_not_null(out, REQUIRED[table]) if clean else out


def _with_natural_key(df: DataFrame, table: str, natural_key: str, ids: str) -> DataFrame:
    fields = list(table_schema("narrow", table, ids).fields)
    fields.insert(1, T.StructField(natural_key, df.schema[natural_key].dataType))
    return conform(df, T.StructType(fields))


def dim_customer_wide(
    customer: DataFrame,
    person: DataFrame,
    phone: DataFrame,
    ids: str = "int",
    clean: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
    held: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Customers with name and first phone number.

    Person and phone meet first (both unique per person by then), so the customers are
    shuffled once, and a customer may have a phone without a person record."""
    one_phone = first_match(
        phone.select("BusinessEntityID", "PhoneNumber"), ["BusinessEntityID"], ["PhoneNumber"]
    )
    people = person.select(
        "BusinessEntityID",
        full_name("FirstName", "MiddleName", "LastName").alias("Name"),
        "EmailPromotion",
        F.col("ModifiedDate").alias("PersonModifiedDate"),
    )
    contacts = people.join(one_phone, "BusinessEntityID", "full_outer").withColumnRenamed(
        "BusinessEntityID", "PersonID"
    )
    numbered = stable_key(customer, "CustomerID", "CustomerKey", held, ids, rows_per_range)
    hot = hot_keys(customer, ["PersonID"], hot_rows)["PersonID"]
    joined = spread_join(numbered, contacts, "PersonID", "left", hot, hot_rows).withColumns(
        {
            # a customer without a person has the name made of no parts: empty, not null
            "Name": F.coalesce("Name", F.lit("")),
            "ModifiedDate": F.coalesce("ModifiedDate", "PersonModifiedDate"),
        }
    )
    return _finish(joined, "DimCustomer", ids, clean)


def dim_customer_narrow(
    customer: DataFrame,
    person: DataFrame,
    email: DataFrame,
    ids: str = "int",
    rows_per_range: int = ROWS_PER_RANGE,
    held: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Customers with names, first e-mail address and whether they are stores."""
    one_email = first_match(
        email.select("BusinessEntityID", "EmailAddress"), ["BusinessEntityID"], ["EmailAddress"]
    )
    contacts = (
        person.select("BusinessEntityID", "FirstName", "LastName")
        .join(one_email, "BusinessEntityID", "left")
        .withColumnRenamed("BusinessEntityID", "PersonID")
    )
    numbered = stable_key(customer, "CustomerID", "CustomerKey", held, ids, rows_per_range)
    hot = hot_keys(customer, ["PersonID"], hot_rows)["PersonID"]
    joined = spread_join(numbered, contacts, "PersonID", "left", hot, hot_rows).withColumn(
        "CustomerType", customer_type("StoreID")
    )
    return _with_natural_key(joined, "DimCustomer", "CustomerID", ids)


def _with_categories(product: DataFrame, subcategory: DataFrame, category: DataFrame) -> DataFrame:
    """The two small lookups meet first and are written once: products are then joined once,
    by broadcast if the written table is below Spark's threshold, else by shuffle."""
    classes = lookup(
        subcategory.select("ProductSubcategoryID", "ProductCategoryID", "Name"),
        category,
        on={"ProductCategoryID": "ProductCategoryID"},
        take={"Name": "CategoryName"},
    )
    return lookup(
        product,
        settle(classes, "product_classes"),
        on={"ProductSubcategoryID": "ProductSubcategoryID"},
        take={"CategoryName": "ProductCategoryName", "Name": "ProductSubcategoryName"},
        hot=hot_keys(product, ["ProductSubcategoryID"])["ProductSubcategoryID"],
    )


def dim_product_wide(
    product: DataFrame,
    subcategory: DataFrame,
    category: DataFrame,
    ids: str = "int",
    clean: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
    held: DataFrame | None = None,
) -> DataFrame:
    numbered = stable_key(product, "ProductID", "ProductKey", held, ids, rows_per_range)
    return _finish(_with_categories(numbered, subcategory, category), "DimProduct", ids, clean)


def dim_product_narrow(
    product: DataFrame,
    subcategory: DataFrame,
    category: DataFrame,
    ids: str = "int",
    rows_per_range: int = ROWS_PER_RANGE,
    held: DataFrame | None = None,
) -> DataFrame:
    numbered = stable_key(product, "ProductID", "ProductKey", held, ids, rows_per_range)
    named = _with_categories(numbered, subcategory, category).withColumnsRenamed(
        {
            "Name": "ProductName",
            "ProductCategoryName": "ProductCategory",
            "ProductSubcategoryName": "ProductSubcategory",
        }
    )
    return _with_natural_key(named, "DimProduct", "ProductID", ids)


def _with_places(address: DataFrame, state: DataFrame, country: DataFrame) -> DataFrame:
    places = lookup(
        state.select("StateProvinceID", "StateProvinceCode", "Name", "CountryRegionCode"),
        country,
        on={"CountryRegionCode": "CountryRegionCode"},
        take={"Name": "CountryRegionName"},
    )
    return lookup(
        address,
        settle(places, "places"),
        on={"StateProvinceID": "StateProvinceID"},
        take={
            "StateProvinceCode": "StateProvinceCode",
            "Name": "StateProvinceName",
            "CountryRegionCode": "CountryRegionCode",
            "CountryRegionName": "CountryRegionName",
        },
        hot=hot_keys(address, ["StateProvinceID"])["StateProvinceID"],
    )


def dim_geography_wide(
    address: DataFrame,
    state: DataFrame,
    country: DataFrame,
    ids: str = "int",
    clean: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
    held: DataFrame | None = None,
) -> DataFrame:
    numbered = stable_key(address, "AddressID", "GeographyKey", held, ids, rows_per_range)
    return _finish(_with_places(numbered, state, country), "DimGeography", ids, clean)


def dim_geography_narrow(
    address: DataFrame,
    state: DataFrame,
    country: DataFrame,
    ids: str = "int",
    rows_per_range: int = ROWS_PER_RANGE,
    held: DataFrame | None = None,
) -> DataFrame:
    numbered = stable_key(address, "AddressID", "GeographyKey", held, ids, rows_per_range)
    named = _with_places(numbered, state, country).withColumnsRenamed(
        {"StateProvinceName": "StateProvince", "CountryRegionName": "CountryRegion"}
    )
    return _with_natural_key(named, "DimGeography", "AddressID", ids)


def all_days(day_columns: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """The days of date or timestamp columns of several tables, one under the other, repeats and
    nulls kept. All columns of one table are read in one scan."""
    parts = [
        df.select(F.explode(F.array(*[F.to_date(c) for c in columns])).alias("Day"))
        for df, columns in day_columns
    ]
    return reduce(DataFrame.unionByName, parts)


def distinct_days(day_columns: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Each non-null day of ``all_days`` once; repeats fold before the shuffle."""
    return all_days(day_columns).where(F.col("Day").isNotNull()).distinct()


def dim_date_wide(
    header: DataFrame, detail: DataFrame, fiscal_start_month: int = 1, clean: bool = True
) -> DataFrame:
    """One row per day on which something was ordered, due, shipped or changed."""
    days = distinct_days(
        [(header, ["OrderDate", "DueDate", "ShipDate"]), (detail, ["ModifiedDate"])]
    )
    full = days.select(
        F.col("Day").alias("FullDateAlternateKey"),
        *[c.alias(name) for name, c in calendar_columns("Day").items()],
        *[c.alias(name) for name, c in fiscal_columns("Day", fiscal_start_month).items()],
        F.col("Day").alias("ModifiedDate"),
    )
    return _finish(full, "DimDate", "int", clean)


def dim_date_narrow(header: DataFrame) -> DataFrame:
    """One row per order day. Times of day are cut off, so a day has one row and one key."""
    days = distinct_days([(header, ["OrderDate"])])
    full = days.select(
        date_key("Day").alias("DateKey"),
        F.col("Day").alias("FullDate"),
        F.year("Day").alias("Year"),
        F.month("Day").alias("Month"),
        F.date_format("Day", "MMMM").alias("MonthName"),
        F.quarter("Day").alias("Quarter"),
    )
    return conform(full, table_schema("narrow", "DimDate"))
