"""The twelve source tables of the stars, derived from a retail schema held as Parquet
(region, nation, customer, supplier, part, orders, lineitem).

Every source table is a projection, so filters and column choices reach the Parquet scans; only
the subcategories need a distinct. The rules plant what the stars must cope with: customers
without a person, second phones and e-mails, missing names, unknown places, products without a
category, order lines with equal ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
MONEY, RATE = "decimal(12,2)", "decimal(4,2)"  # a product of both still fits 18 digits


def retail_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _padded(key: Column, width: int) -> Column:
    return F.lpad(key.cast("string"), width, "0")


def _day(key: Column, first: str, span: int) -> Column:
    return F.date_add(F.lit(first).cast("date"), F.pmod(key, F.lit(span)).cast("int"))


def _customer(read) -> DataFrame:
    key = F.col("c_custkey")
    return read("customer").select(
        key.alias("CustomerID"),
        F.when(key % 7 != 0, key).alias("PersonID"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), key).alias("StoreID"),
        F.col("c_nationkey").alias("TerritoryID"),
        F.concat(F.lit("AC"), _padded(key, 12)).alias("AccountNumber"),
        F.when(key % 11 != 0, _day(key, "1995-01-01", 1000)).alias("ModifiedDate"),
    )


def _person(read) -> DataFrame:
    key, name = F.col("c_custkey"), F.split("c_name", "#")
    return read("customer").select(
        F.when(key % 7 != 0, key).otherwise(-key).alias("BusinessEntityID"),
        name[0].alias("FirstName"),
        F.when(key % 3 != 0, F.col("c_mktsegment")).alias("MiddleName"),
        name[1].alias("LastName"),
        (key % 3).cast("int").alias("EmailPromotion"),
        _day(key, "1996-01-01", 500).alias("ModifiedDate"),
    )


def _contacts(read, name: str, first: Column, second: Column) -> DataFrame:
    """One row per customer, and a second one for each fifth."""
    key = F.col("c_custkey")
    both = F.when(key % 5 == 0, F.array(second, first)).otherwise(F.array(first))
    return read("customer").select(key.alias("BusinessEntityID"), F.explode(both).alias(name))


def _phone(read) -> DataFrame:
    number = _padded(F.col("c_custkey"), 10)
    return _contacts(
        read, "PhoneNumber", F.concat(F.lit("1-"), number), F.concat(F.lit("2-"), number)
    )


def _email(read) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    return _contacts(
        read,
        "EmailAddress",
        F.concat(F.lit("a"), key, F.lit("@example.com")),
        F.concat(F.lit("b"), key, F.lit("@example.com")),
    )


def _product(read) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    price = F.col("p_retailprice").cast(MONEY)
    return read("part").select(
        key.alias("ProductID"),
        F.when(size % 10 != 0, F.col("p_brand")).alias("ProductSubcategoryID"),
        F.col("p_name").alias("Name"),
        F.concat(F.lit("PN-"), key.cast("string")).alias("ProductNumber"),
        (size % 2).alias("MakeFlag"),
        (size % 3).alias("FinishedGoodsFlag"),
        F.when(size % 4 != 0, F.split("p_name", " ")[0]).alias("Color"),
        (size * 10).alias("SafetyStockLevel"),
        (size * 5).alias("ReorderPoint"),
        (price * F.lit("0.6").cast("decimal(2,1)")).alias("StandardCost"),
        price.alias("ListPrice"),
        size.cast("string").alias("Size"),
        F.when(size % 2 == 0, F.lit("CM")).alias("SizeUnitMeasureCode"),
        (size.cast("decimal(10,0)") * F.lit("1.25").cast("decimal(3,2)")).alias("Weight"),
        F.when(size % 3 == 0, F.lit("LB")).alias("WeightUnitMeasureCode"),
        (size % 5).alias("DaysToManufacture"),
        F.substring("p_type", 1, 1).alias("ProductLine"),
        F.when(size % 7 == 0, F.lit("H")).alias("Class"),
        F.when(size % 6 == 0, F.lit("U")).alias("Style"),
        _day(key, "1994-01-01", 1000).alias("ModifiedDate"),
    )


def _subcategory(read) -> DataFrame:
    brand = F.col("p_brand")
    return read("part").select("p_brand").distinct().select(
        brand.alias("ProductSubcategoryID"),
        (F.substring(brand, 7, 10).cast("int") % 4).alias("ProductCategoryID"),
        F.concat(F.lit("Sub "), brand).alias("Name"),
    )


def _category(read) -> DataFrame:
    """Categories 0 to 2, the others moved: the subcategories of key 3 have none."""
    key = F.col("r_regionkey")
    return read("region").select(
        F.when(key < 3, key).otherwise(key + 100).alias("ProductCategoryID"), F.concat(F.lit("Cat "), F.col("r_name")).alias("Name")
    )


def _address(read) -> DataFrame:
    """Customers have the even ids, suppliers the odd ones."""
    customers = read("customer").select(
        (F.col("c_custkey") * 2).alias("AddressID"),
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("AddressLine1"),
        F.col("c_nationkey").alias("nation"),
    )
    suppliers = read("supplier").select(
        (F.col("s_suppkey") * 2 + 1).alias("AddressID"),
        F.col("s_suppkey").alias("key"),
        F.col("s_name").alias("AddressLine1"),
        F.col("s_nationkey").alias("nation"),
    )
    key = F.col("key")
    return customers.unionByName(suppliers).select(
        "AddressID",
        "AddressLine1",
        F.when(key % 3 == 0, F.concat(F.lit("Unit "), key.cast("string"))).alias("AddressLine2"),
        F.concat(F.lit("City "), F.pmod(key, F.lit(97)).cast("string")).alias("City"),
        F.when(key % 17 != 0, F.col("nation")).alias("StateProvinceID"),
        F.when(key % 19 != 0, _padded(key % 100000, 5)).alias("PostalCode"),
        _day(key, "1993-01-01", 700).alias("ModifiedDate"),
    )


def _state(read) -> DataFrame:
    return read("nation").select(
        F.col("n_nationkey").alias("StateProvinceID"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("StateProvinceCode"),
        F.col("n_name").alias("Name"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("CountryRegionCode"),
    )


def _country(read) -> DataFrame:
    return read("region").select(
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("CountryRegionCode"),
        F.col("r_name").alias("Name"),
    )


def _header(read) -> DataFrame:
    day = F.to_date("o_orderdate")
    return read("orders").select(
        F.col("o_orderkey").alias("SalesOrderID"),
        F.col("o_custkey").alias("CustomerID"),
        (F.col("o_custkey") * 2).alias("BillToAddressID"),
        F.col("o_orderdate").alias("OrderDate"),
        F.date_add(day, 12).alias("DueDate"),
        F.when(F.col("o_orderstatus") != "O", F.date_add(day, 7)).alias("ShipDate"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("OnlineOrderFlag"),
        F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")).alias("SalesOrderNumber"),
        F.date_add(day, 7).alias("ModifiedDate"),
    )


def _detail(read) -> DataFrame:
    """Lines are shipped from the supplier, whose address is the line's place."""
    price, discount = F.col("l_extendedprice").cast(MONEY), F.col("l_discount").cast(RATE)
    return read("lineitem").select(
        F.col("l_orderkey").alias("SalesOrderID"),
        F.col("l_linenumber").alias("SalesOrderDetailID"),
        F.col("l_partkey").alias("ProductID"),
        (F.col("l_suppkey") * 2 + 1).alias("ShipToAddressID"),
        F.col("l_quantity").alias("OrderQty"),
        price.alias("UnitPrice"),
        discount.alias("UnitPriceDiscount"),
        (price * (F.lit(1).cast("decimal(1,0)") - discount)).alias("LineTotal"),
        F.when(
            F.col("l_returnflag") != "N", F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
        ).alias("CarrierTrackingNumber"),
        F.col("l_shipdate").alias("ModifiedDate"),
    )


SOURCES: dict[str, Callable] = {
    "Customer": _customer,
    "Person": _person,
    "PersonPhone": _phone,
    "EmailAddress": _email,
    "Product": _product,
    "ProductSubcategory": _subcategory,
    "ProductCategory": _category,
    "Address": _address,
    "StateProvince": _state,
    "CountryRegion": _country,
    "SalesOrderHeader": _header,
    "SalesOrderDetail": _detail,
}


def retail_source(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """``source(name)`` over the Parquet tables in ``folder``."""

    opened: dict[str, DataFrame] = {}

    def read(table: str) -> DataFrame:
        if table not in opened:
            opened[table] = retail_table(spark, folder, table)
        return opened[table]

    return lambda name: SOURCES[name](read)
