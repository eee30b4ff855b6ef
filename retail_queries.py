"""Every operator as a query over the retail tables: ``QUERIES[name](spark, folder)``.

All queries read whole tables. Those over a star read the tables of ``star_tables``, which builds
each model once per application and folder, as a warehouse does, and keeps it in the cluster's
shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import calendar_columns, customer_type, date_key, fiscal_columns, full_name
from starloom.functions.texts import bit_of, money_of, seconds_of_day, timestamp_of
from starloom.operators.audit import (
    audit_cast,
    audit_foreign_key,
    audit_length,
    audit_not_null,
    audit_range,
    audit_summary,
    audit_unique,
)
from starloom.operators.changes import (
    apply_changes,
    new_rows,
    sparse_set,
    xml_fields,
    xml_values,
)
from starloom.operators.keys import dense_key
from starloom.operators.lookup import lookup
from starloom.operators.marts import largest_first, revenue_by, revenue_rollup, top_k, total_of
from starloom.operators.privacy import classify, masked
from starloom.operators.shape import conform, dedupe, first_match, inspect, require_not_null
from starloom.operators.skew import hot_keys
from starloom.operators.timeintel import growth, same_period_last_year
from starloom.plans import dims as D
from starloom.plans.facts import fact_narrow, fact_wide
from starloom.plans.schemas import (
    DIMENSIONS,
    FACT,
    FOREIGN_KEYS,
    MAX_LENGTHS,
    PRIMARY_KEYS,
    table_schema,
)
from starloom.plans.rejects import reject_counts
from starloom.plans.star import build_dimensions, reports, run_warehouse
from starloom.sinks import ParquetSink, load_star, save_tables, write_csv, write_parquet
from starloom.sources.dumps import read_records, read_tsv, tsv_records
from starloom.sources.retail import SOURCES, retail_source, retail_table
from starloom.staging import new_path, settle

Query = Callable[[SparkSession, str], DataFrame]

IDS = "bigint"  # source ids and keys of these tables can pass 2^31 rows
QUERIES: dict[str, Query] = {}
_built: dict[tuple, tuple[tuple, dict[str, DataFrame]]] = {}
_lock = RLock()


def query(fn: Query) -> Query:
    """Register ``fn`` by its name; a trailing ``_query`` is left out."""
    QUERIES[fn.__name__.removesuffix("_query")] = fn
    return fn


def _files(spark: SparkSession, folder: str) -> tuple:
    """Name, time and size of what lies in the folder and one level below."""
    context = spark.sparkContext
    top = context._jvm.org.apache.hadoop.fs.Path(folder)
    system = top.getFileSystem(context._jsc.hadoopConfiguration())
    found = list(system.listStatus(top))
    found += [f for d in found if d.isDirectory() for f in system.listStatus(d.getPath())]
    return tuple((f.getPath().getName(), f.getModificationTime(), f.getLen()) for f in found)


def _once(spark: SparkSession, folder: str, part: str, build) -> dict[str, DataFrame]:
    """Built anew when the source's files have changed."""
    key, state = (spark.sparkContext.applicationId, folder, part), _files(spark, folder)
    with _lock:
        if key not in _built or _built[key][0] != state:
            _built[key] = (state, build())
        return _built[key][1]


def dimension_tables(spark: SparkSession, folder: str, model: str) -> dict[str, DataFrame]:
    """Written dimensions; the narrow ones with their natural keys."""
    source = retail_source(spark, folder)
    return _once(spark, folder, f"{model} dims", lambda: build_dimensions(source, model, IDS))


def fact_plan(spark: SparkSession, folder: str, model: str, **options) -> DataFrame:
    source = retail_source(spark, folder)
    build = fact_wide if model == "wide" else fact_narrow
    return build(
        source("SalesOrderHeader"),
        source("SalesOrderDetail"),
        dimension_tables(spark, folder, model),
        ids=IDS,
        **options,
    )


def star_tables(spark: SparkSession, folder: str, model: str) -> dict[str, DataFrame]:
    """All five written tables of a star, in their published columns."""

    def build() -> dict[str, DataFrame]:
        dims = dimension_tables(spark, folder, model)
        star = {n: conform(dims[n], table_schema(model, n, IDS)) for n in DIMENSIONS}
        return {**star, FACT: settle(fact_plan(spark, folder, model), FACT)}

    return _once(spark, folder, f"{model} star", build)


# --- sources -------------------------------------------------------------------------------


def _scan(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return retail_source(spark, folder)(name)


SCANS = {
    "scan_customer": "Customer",
    "scan_person": "Person",
    "scan_person_phone": "PersonPhone",
    "scan_email_address": "EmailAddress",
    "scan_product": "Product",
    "scan_product_subcategory": "ProductSubcategory",
    "scan_product_category": "ProductCategory",
    "scan_address": "Address",
    "scan_state_province": "StateProvince",
    "scan_country_region": "CountryRegion",
    "scan_sales_order_header": "SalesOrderHeader",
    "scan_sales_order_detail": "SalesOrderDetail",
}
assert set(SCANS.values()) == set(SOURCES)
QUERIES.update({name: partial(_scan, table) for name, table in SCANS.items()})


@query
def preview_sales_order_header(spark: SparkSession, folder: str) -> DataFrame:
    header = retail_source(spark, folder)("SalesOrderHeader")
    return inspect(header.orderBy("SalesOrderID"), 5, quiet=True)


@query
def scan_tab_separated(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written as a dump without header and quotes, nulls as empty fields, read back
    with a declared schema."""
    table = retail_source(spark, folder)("Customer")
    path = new_path(spark, "customer_dump")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in table.columns]
    text = table.select(F.concat_ws("\t", *fields))
    text.write.text(path)
    return read_tsv(spark, path, table.schema)


@query
def scan_multi_line_records(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as unquoted records whose text spans lines, read back by the pattern
    that starts a record."""
    documents = retail_table(spark, folder, "documents").select("doc_id", "n_chars", "text")
    path = new_path(spark, "document_dump")
    documents.select(
        F.concat_ws("\t", F.col("doc_id").cast("string"), F.col("n_chars").cast("string"), "text")
    ).write.text(path)
    return read_records(spark, path, r"^\d+\t\d+\t", documents.schema, free_tail=True)


@query
def scan_records_with_tabs(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a tab and a line break planted in each text: the last field keeps them."""
    documents = retail_table(spark, folder, "documents").select("doc_id", "n_chars", "text")
    path = new_path(spark, "tabbed_dump")
    planted = F.concat("text", F.lit("\tafter a tab\nand a line\tto its end"))
    documents.select(
        F.concat_ws("\t", F.col("doc_id").cast("string"), F.col("n_chars").cast("string"), planted)
    ).write.text(path)
    return read_records(spark, path, r"^\d+\t\d+\t", documents.schema, free_tail=True)


@query
def scan_reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as a dump in which some have a field too many and some a text for a number:
    rows read and rejects, counted by reason."""
    key = F.col("l_orderkey")
    fields = [
        key.cast("string"),
        F.when(key % 5 == 0, F.lit("many")).otherwise(F.col("l_linenumber").cast("string")),
        F.when(key % 7 == 0, F.lit("N\tand more")).otherwise(F.col("l_returnflag")),
    ]
    path = new_path(spark, "faulty_dump")
    retail_table(spark, folder, "lineitem").select(F.concat_ws("\t", *fields)).write.text(path)
    schema = T.StructType.fromDDL("l_orderkey bigint, l_linenumber int, l_returnflag string")
    rows, rejects = tsv_records(spark, path, schema)
    outcome = rows.select(F.lit("read").alias("Outcome")).union(rejects.select("reason"))
    return outcome.groupBy("Outcome").agg(F.count("*").alias("Rows"))


# --- dimensions ----------------------------------------------------------------------------


@query
def dim_customer_wide(spark: SparkSession, folder: str) -> DataFrame:
    s = retail_source(spark, folder)
    return D.dim_customer_wide(s("Customer"), s("Person"), s("PersonPhone"), IDS)


@query
def dim_customer_wide_uncleaned(spark: SparkSession, folder: str) -> DataFrame:
    s = retail_source(spark, folder)
    return D.dim_customer_wide(s("Customer"), s("Person"), s("PersonPhone"), IDS, clean=False)


@query
def dim_customer_narrow(spark: SparkSession, folder: str) -> DataFrame:
    s = retail_source(spark, folder)
    dim = D.dim_customer_narrow(s("Customer"), s("Person"), s("EmailAddress"), IDS)
    return conform(dim, table_schema("narrow", "DimCustomer", IDS))


def _goods(spark: SparkSession, folder: str) -> list[DataFrame]:
    s = retail_source(spark, folder)
    return [s("Product"), s("ProductSubcategory"), s("ProductCategory")]


def _places(spark: SparkSession, folder: str) -> list[DataFrame]:
    s = retail_source(spark, folder)
    return [s("Address"), s("StateProvince"), s("CountryRegion")]


@query
def dim_product_wide(spark: SparkSession, folder: str) -> DataFrame:
    return D.dim_product_wide(*_goods(spark, folder), IDS)


@query
def dim_product_narrow(spark: SparkSession, folder: str) -> DataFrame:
    dim = D.dim_product_narrow(*_goods(spark, folder), IDS)
    return conform(dim, table_schema("narrow", "DimProduct", IDS))


@query
def dim_geography_wide(spark: SparkSession, folder: str) -> DataFrame:
    return D.dim_geography_wide(*_places(spark, folder), IDS)


@query
def dim_geography_narrow(spark: SparkSession, folder: str) -> DataFrame:
    dim = D.dim_geography_narrow(*_places(spark, folder), IDS)
    return conform(dim, table_schema("narrow", "DimGeography", IDS))


@query
def dim_date_wide(spark: SparkSession, folder: str) -> DataFrame:
    s = retail_source(spark, folder)
    return D.dim_date_wide(s("SalesOrderHeader"), s("SalesOrderDetail"))


@query
def dim_date_wide_fiscal_july(spark: SparkSession, folder: str) -> DataFrame:
    s = retail_source(spark, folder)
    return D.dim_date_wide(s("SalesOrderHeader"), s("SalesOrderDetail"), fiscal_start_month=7)


@query
def dim_date_narrow(spark: SparkSession, folder: str) -> DataFrame:
    return D.dim_date_narrow(retail_source(spark, folder)("SalesOrderHeader"))


def _day_columns(spark: SparkSession, folder: str) -> list[tuple[DataFrame, list[str]]]:
    s = retail_source(spark, folder)
    return [
        (s("SalesOrderHeader"), ["OrderDate", "DueDate", "ShipDate"]),
        (s("SalesOrderDetail"), ["ModifiedDate"]),
    ]


@query
def distinct_days(spark: SparkSession, folder: str) -> DataFrame:
    events = (retail_table(spark, folder, "events"), ["ts"])
    return D.distinct_days([*_day_columns(spark, folder), events])


@query
def union_all_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days of four columns one under the other, repeats kept, then counted."""
    days = D.all_days(_day_columns(spark, folder))
    return days.groupBy("Day").agg(F.count(F.lit(1)).alias("Rows"))


@query
def surrogate_key_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Dense key over a large integer id, numbered range by range."""
    header = retail_source(spark, folder)("SalesOrderHeader").select("SalesOrderID")
    return dense_key(header, "SalesOrderID", "OrderKey", IDS, rows_per_range=4_000)


@query
def surrogate_key_text(spark: SparkSession, folder: str) -> DataFrame:
    """Dense key over text, one row per value, numbered partition by sorted partition."""
    mail = retail_source(spark, folder)("EmailAddress")
    return dense_key(mail, "EmailAddress", "MailKey", IDS, unique=False, rows_per_range=400)


# --- joins one by one ----------------------------------------------------------------------


def _person_lookup(
    spark: SparkSession, folder: str, columns: list[str], table: str, take: dict[str, str]
) -> DataFrame:
    """Attributes of each customer's person; many customers may have the same or none."""
    s = retail_source(spark, folder)
    customer = s("Customer").select("CustomerID", "PersonID", *columns)
    hot = hot_keys(customer, ["PersonID"])["PersonID"]
    return lookup(customer, s(table), {"PersonID": "BusinessEntityID"}, take, hot=hot)


@query
def lookup_customer_person(spark: SparkSession, folder: str) -> DataFrame:
    take = {"LastName": "PersonLastName", "ModifiedDate": "PersonModifiedDate"}
    return _person_lookup(spark, folder, [], "Person", take)


@query
def lookup_customer_all_phones(spark: SparkSession, folder: str) -> DataFrame:
    """The left join as such: a customer with two phones gives two rows."""
    return _person_lookup(spark, folder, [], "PersonPhone", {"PhoneNumber": "PhoneNumber"})


@query
def lookup_person_all_emails(spark: SparkSession, folder: str) -> DataFrame:
    s = retail_source(spark, folder)
    return lookup(
        s("Person").select("BusinessEntityID", "LastName"),
        s("EmailAddress"),
        on={"BusinessEntityID": "BusinessEntityID"},
        take={"EmailAddress": "EmailAddress"},
    )


@query
def lookup_product_category(spark: SparkSession, folder: str) -> DataFrame:
    product, subcategory, category = _goods(spark, folder)
    named = lookup(
        product.select("ProductID", "ProductSubcategoryID"),
        settle(subcategory, "subcategories"),
        on={"ProductSubcategoryID": "ProductSubcategoryID"},
        take={"Name": "SubcategoryName", "ProductCategoryID": "ProductCategoryID"},
    )
    return lookup(
        named, category, {"ProductCategoryID": "ProductCategoryID"}, {"Name": "CategoryName"}
    )


@query
def lookup_address_country(spark: SparkSession, folder: str) -> DataFrame:
    address, state, country = _places(spark, folder)
    placed = lookup(
        address.select("AddressID", "StateProvinceID"),
        state,
        on={"StateProvinceID": "StateProvinceID"},
        take={"Name": "StateName", "CountryRegionCode": "CountryRegionCode"},
    )
    return lookup(
        placed, country, {"CountryRegionCode": "CountryRegionCode"}, {"Name": "CountryName"}
    )


@query
def join_header_detail(spark: SparkSession, folder: str) -> DataFrame:
    s = retail_source(spark, folder)
    header, detail = s("SalesOrderHeader"), s("SalesOrderDetail")
    header = header.withColumnRenamed("ModifiedDate", "HeaderModifiedDate")
    return (
        header.alias("h")
        .join(detail.alias("d"), F.col("h.SalesOrderID") == F.col("d.SalesOrderID"))
        .select("h.SalesOrderID", "d.SalesOrderDetailID", "d.LineTotal", "h.HeaderModifiedDate")
    )


# --- facts ---------------------------------------------------------------------------------


@query
def fact_wide_query(spark: SparkSession, folder: str) -> DataFrame:
    return fact_plan(spark, folder, "wide")


@query
def fact_wide_left_query(spark: SparkSession, folder: str) -> DataFrame:
    return fact_plan(spark, folder, "wide", geo_join="left")


@query
def fact_wide_bill(spark: SparkSession, folder: str) -> DataFrame:
    return fact_plan(spark, folder, "wide", geo_role="bill")


@query
def fact_wide_hot_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows as ``fact_wide``, built as if keys with more rows than one in 1,500 orders
    were too large for a task."""
    orders = retail_table(spark, folder, "orders").count()
    return fact_plan(spark, folder, "wide", hot_rows=max(2, orders // 1_500))


@query
def fact_narrow_query(spark: SparkSession, folder: str) -> DataFrame:
    return fact_plan(spark, folder, "narrow")


@query
def fact_narrow_ship(spark: SparkSession, folder: str) -> DataFrame:
    return fact_plan(spark, folder, "narrow", geo_role="ship")


# --- expressions and rules -----------------------------------------------------------------


@query
def name_concat(spark: SparkSession, folder: str) -> DataFrame:
    parts = ("FirstName", "MiddleName", "LastName")
    return retail_source(spark, folder)("Person").select(
        "BusinessEntityID",
        full_name(*parts).alias("Name"),
        full_name(*parts, blank_middle=True).alias("SpacedName"),
    )


@query
def customer_types(spark: SparkSession, folder: str) -> DataFrame:
    return retail_source(spark, folder)("Customer").select(
        "CustomerID", customer_type("StoreID").alias("CustomerType")
    )


@query
def modified_date_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    take = {"ModifiedDate": "PersonModifiedDate"}
    joined = _person_lookup(spark, folder, ["ModifiedDate"], "Person", take)
    return joined.select(
        "CustomerID", F.coalesce("ModifiedDate", "PersonModifiedDate").alias("ModifiedDate")
    )


@query
def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar attributes of event timestamps, which have times of day."""
    return retail_table(spark, folder, "events").select(
        "event_id",
        F.to_date("ts").alias("Day"),
        *[c.alias(n) for n, c in calendar_columns("ts").items() if n != "DateKey"],
    )


@query
def smart_date_key(spark: SparkSession, folder: str) -> DataFrame:
    return retail_source(spark, folder)("SalesOrderHeader").select(
        "SalesOrderID", date_key("OrderDate").alias("OrderDateKey")
    )


@query
def fiscal_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return retail_table(spark, folder, "events").select(
        "event_id", *[c.alias(n) for n, c in fiscal_columns("ts", 10).items()]
    )


def _planted_nulls(spark: SparkSession, folder: str) -> DataFrame:
    orders = retail_table(spark, folder, "orders")
    return orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.to_date("o_orderdate").alias("day"),
    )


@query
def required_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return require_not_null(_planted_nulls(spark, folder), ["status", "priority"])


@query
def conform_types(spark: SparkSession, folder: str) -> DataFrame:
    """One select to a declared schema: names, order and types."""
    schema = T.StructType.fromDDL(
        "l_orderkey bigint, l_linenumber smallint, l_quantity int, l_extendedprice decimal(19,4), "
        "l_discount decimal(10,4), l_tax decimal(10,2), l_shipdate date, l_returnflag string, "
        "open boolean"
    )
    lines = retail_table(spark, folder, "lineitem")
    return conform(lines.withColumn("open", (F.col("l_linestatus") == "O").cast("int")), schema)


def _large_totals(spark: SparkSession, folder: str) -> DataFrame:
    total = F.col("o_totalprice").cast("decimal(15,2)")
    return retail_table(spark, folder, "orders").select(
        F.col("o_orderkey"), (total * 10).alias("total"), F.col("o_custkey").alias("quantity")
    )


@query
def tolerant_casts(spark: SparkSession, folder: str) -> DataFrame:
    schema = T.StructType.fromDDL("o_orderkey bigint, total decimal(10,4), quantity tinyint")
    return conform(_large_totals(spark, folder), schema, tolerant=["total", "quantity"])


@query
def dedupe_order_line(spark: SparkSession, folder: str) -> DataFrame:
    detail = retail_source(spark, folder)("SalesOrderDetail")
    return dedupe(detail, ["SalesOrderID", "SalesOrderDetailID"])


@query
def first_phone(spark: SparkSession, folder: str) -> DataFrame:
    phones = retail_source(spark, folder)("PersonPhone")
    return first_match(phones, ["BusinessEntityID"], ["PhoneNumber"])


# --- reports -------------------------------------------------------------------------------


def _report(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return reports(star_tables(spark, folder, "wide"), "wide")[name]


for _name in ("revenue_by_category", "revenue_by_city", "revenue_by_year"):
    QUERIES[_name] = partial(_report, _name)


def _narrow_by(spark: SparkSession, folder: str, dim: str, key: str, *attrs: str) -> DataFrame:
    star = star_tables(spark, folder, "narrow")
    return revenue_by(star[FACT], star[dim], key, attrs, "SalesAmount", "TotalSales")


@query
def top_cities(spark: SparkSession, folder: str) -> DataFrame:
    sums = _narrow_by(spark, folder, "DimGeography", "GeographyKey", "City")
    return top_k(sums, "TotalSales", 20)


@query
def sales_by_category(spark: SparkSession, folder: str) -> DataFrame:
    sums = _narrow_by(spark, folder, "DimProduct", "ProductKey", "ProductCategory")
    return largest_first(sums, "TotalSales")


@query
def sales_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return _narrow_by(spark, folder, "DimDate", "DateKey", "FullDate").orderBy("FullDate")


@query
def sales_by_customer_type(spark: SparkSession, folder: str) -> DataFrame:
    return _narrow_by(spark, folder, "DimCustomer", "CustomerKey", "CustomerType")


@query
def sales_by_country(spark: SparkSession, folder: str) -> DataFrame:
    return _narrow_by(spark, folder, "DimGeography", "GeographyKey", "CountryRegion")


@query
def sales_by_state(spark: SparkSession, folder: str) -> DataFrame:
    levels = ("CountryRegion", "StateProvince")
    return _narrow_by(spark, folder, "DimGeography", "GeographyKey", *levels)


@query
def sales_by_place(spark: SparkSession, folder: str) -> DataFrame:
    levels = ("CountryRegion", "StateProvince", "City")
    return _narrow_by(spark, folder, "DimGeography", "GeographyKey", *levels)


@query
def sales_by_geo_rollup(spark: SparkSession, folder: str) -> DataFrame:
    star = star_tables(spark, folder, "narrow")
    levels = ["CountryRegion", "StateProvince", "City"]
    return revenue_rollup(
        star[FACT], star["DimGeography"], "GeographyKey", levels, "SalesAmount", "TotalSales"
    )


@query
def total_sales(spark: SparkSession, folder: str) -> DataFrame:
    return total_of(star_tables(spark, folder, "narrow")[FACT], "SalesAmount", "TotalSales")


@query
def sales_last_year(spark: SparkSession, folder: str) -> DataFrame:
    star = star_tables(spark, folder, "narrow")
    return same_period_last_year(star[FACT], star["DimDate"], ["Year"])


def _growth(context: list[str], spark: SparkSession, folder: str) -> DataFrame:
    star = star_tables(spark, folder, "narrow")
    return growth(star[FACT], star["DimDate"], context)


QUERIES["growth_global"] = partial(_growth, [])
QUERIES["growth_by_year"] = partial(_growth, ["Year"])
QUERIES["growth_by_quarter"] = partial(_growth, ["Year", "Quarter"])
QUERIES["growth_by_month"] = partial(_growth, ["Year", "Month"])
QUERIES["growth_by_date"] = partial(_growth, ["FullDate"])


# --- audits --------------------------------------------------------------------------------


@query
def audit_primary_key(spark: SparkSession, folder: str) -> DataFrame:
    """Duplicated key values of each narrow dimension, counted."""
    star = star_tables(spark, folder, "narrow")
    return audit_summary({n: audit_unique(star[n], PRIMARY_KEYS[n]) for n in DIMENSIONS})


@query
def audit_order_line_key(spark: SparkSession, folder: str) -> DataFrame:
    detail = retail_source(spark, folder)("SalesOrderDetail")
    return audit_unique(detail, ["SalesOrderID", "SalesOrderDetailID"])


@query
def audit_fact_key(spark: SparkSession, folder: str) -> DataFrame:
    return audit_unique(star_tables(spark, folder, "narrow")[FACT], PRIMARY_KEYS[FACT])


@query
def audit_foreign_key_query(spark: SparkSession, folder: str) -> DataFrame:
    star = star_tables(spark, folder, "narrow")
    return audit_summary(
        {
            key: audit_foreign_key(star[FACT], star[dim], key)
            for key, dim in FOREIGN_KEYS[FACT].items()
        }
    )


@query
def audit_foreign_key_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of the narrow fact that the cleaned wide dimension has dropped."""
    fact = star_tables(spark, folder, "narrow")[FACT]
    customers = dimension_tables(spark, folder, "wide")["DimCustomer"]
    return audit_foreign_key(fact, customers, "CustomerKey")


@query
def audit_not_null_query(spark: SparkSession, folder: str) -> DataFrame:
    fact = star_tables(spark, folder, "narrow")[FACT]
    return audit_not_null(fact, fact.columns)


@query
def audit_nulls_planted(spark: SparkSession, folder: str) -> DataFrame:
    return audit_not_null(_planted_nulls(spark, folder), ["status", "priority", "day"])


@query
def audit_length_query(spark: SparkSession, folder: str) -> DataFrame:
    dim = star_tables(spark, folder, "narrow")["DimCustomer"]
    return audit_length(dim, {**MAX_LENGTHS["DimCustomer"], "EmailAddress": 14})


@query
def audit_range_query(spark: SparkSession, folder: str) -> DataFrame:
    detail = retail_source(spark, folder)("SalesOrderDetail")
    return audit_range(detail, {"OrderQty": (1, 45), "SalesOrderDetailID": (-32768, 32767)})


@query
def audit_cast_query(spark: SparkSession, folder: str) -> DataFrame:
    types = {"total": "decimal(10,4)", "quantity": "tinyint"}
    return audit_cast(_large_totals(spark, folder), types)


# --- changes, privacy, semi-structured columns ---------------------------------------------


@query
def apply_changes_query(spark: SparkSession, folder: str) -> DataFrame:
    """Deletes, updates and inserts, with some of each that do not apply."""
    target = retail_table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    key = F.col("c_custkey")
    step = key % 10
    op = F.when(step == 0, "D").when(step.isin(1, 4), "U").when(step.isin(2, 3), "I")
    changes = target.select(
        F.when(step.isin(2, 4), -key - 1).otherwise(key).alias("c_custkey"),
        F.concat(F.lit("New "), "c_name").alias("c_name"),
        F.when(step != 1, F.col("c_nationkey")).alias("c_nationkey"),
        op.alias("op"),
    ).where(F.col("op").isNotNull())
    return apply_changes(target, changes, ["c_custkey"])


@query
def append_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All customers appended to a table that holds those of the first nations: none twice."""
    customers = retail_source(spark, folder)("Customer")
    path = new_path(spark, "appended")
    write_parquet(customers.where("TerritoryID < 10"), path)
    held = spark.read.parquet(path)
    write_parquet(new_rows(customers, held, ["CustomerID"]), path, mode="append")
    return spark.read.parquet(path)


@query
def sparse_set_query(spark: SparkSession, folder: str) -> DataFrame:
    product = retail_source(spark, folder)("Product")
    sparse = ["Color", "SizeUnitMeasureCode", "WeightUnitMeasureCode", "Class", "Style"]
    out = sparse_set(product.select("ProductID", *sparse), sparse)
    entry = F.transform(F.map_entries("ColumnSet"), lambda e: F.concat(e.key, F.lit("="), e.value))
    return out.select("ProductID", F.array_join(entry, ";").alias("ColumnSet"))


@query
def masked_customers(spark: SparkSession, folder: str) -> DataFrame:
    labelled = classify(
        retail_table(spark, folder, "customer"),
        {"c_name": ("PII", "Person name"), "c_acctbal": ("Confidential", "Financial")},
    )
    return masked(labelled)


def _customer_xml(spark: SparkSession, folder: str) -> DataFrame:
    def tag(name: str, column: str):
        return F.concat(F.lit(f"<{name}>"), F.col(column).cast("string"), F.lit(f"</{name}>"))

    balance = F.when(F.col("c_acctbal") >= 0, tag("balance", "c_acctbal")).otherwise(F.lit(""))
    body = F.concat(
        F.lit("<contact>"), tag("name", "c_name"), tag("nation", "c_nationkey"), balance,
        F.lit("</contact>"),
    )
    return retail_table(spark, folder, "customer").select("c_custkey", body.alias("doc"))


@query
def xml_fields_query(spark: SparkSession, folder: str) -> DataFrame:
    schema = "name string, nation int, balance double"
    return xml_fields(_customer_xml(spark, folder), "doc", schema)


@query
def xml_values_query(spark: SparkSession, folder: str) -> DataFrame:
    paths = {"name": "/contact/name", "nation": "/contact/nation", "balance": "/contact/balance"}
    out = xml_values(_customer_xml(spark, folder), "doc", paths).drop("doc")
    return out.withColumn("balance", F.col("balance").cast("double"))


# --- sinks ---------------------------------------------------------------------------------


@query
def sink_roundtrip_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """The wide fact by calendar year, one folder each, rows sorted by day inside."""
    fact = star_tables(spark, folder, "wide")[FACT].withColumn("Year", F.year("OrderDate"))
    path = new_path(spark, "fact_by_year")
    write_parquet(fact, path, partition_by=["Year"], sort_by=["DateKey", "CustomerKey"])
    written = spark.read.parquet(path)
    return written.select("Year", "SalesOrderID", "SalesOrderDetailID", "LineTotal")


@query
def sink_roundtrip_csv(spark: SparkSession, folder: str) -> DataFrame:
    report = reports(star_tables(spark, folder, "wide"), "wide")["revenue_by_city"]
    path = new_path(spark, "revenue_by_city")
    write_csv(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


@query
def sink_roundtrip_table(spark: SparkSession, folder: str) -> DataFrame:
    """The narrow star recreated as catalog tables, then joined by name."""
    root = new_path(spark, "catalog")
    database = "starloom_" + root.split("/")[-2]  # never an existing one: its tables are dropped
    save_tables(star_tables(spark, folder, "narrow"), root, database)
    fact, product = spark.table(f"{database}.{FACT}"), spark.table(f"{database}.DimProduct")
    return revenue_by(fact, product, "ProductKey", ["ProductSubcategory"], "SalesAmount")


@query
def loaded_star_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each narrow table after an ordered load to sorted Parquet."""
    star, root = star_tables(spark, folder, "narrow"), new_path(spark, "loaded")
    sink = ParquetSink(root)
    load_star(star, sink)
    loaded = {name: sink.read(spark, name) for name in star}
    return audit_summary(loaded).withColumnsRenamed({"Rule": "TableName", "Findings": "Rows"})


# --- whole runs ----------------------------------------------------------------------------


def _marts(star: dict[str, DataFrame], model: str) -> DataFrame:
    """The three published reports under one another."""
    parts = [
        df.select(
            F.lit(name).alias("Report"),
            F.col(df.columns[0]).cast("string").alias("Value"),
            "TotalRevenue",
        )
        for name, df in reports(star, model).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _run(model: str, spark: SparkSession, folder: str) -> DataFrame:
    """Source tables to a written star to its reports, the fact in folders by year and month."""
    sink = ParquetSink(new_path(spark, f"run_{model}"), partition_by=["Year", "Month"])
    return _marts(run_warehouse(retail_source(spark, folder), sink, model, ids=IDS), model)


def _twice(model: str, spark: SparkSession, folder: str) -> DataFrame:
    """The same source loaded twice by appending: rows of each table."""
    sink, source = ParquetSink(new_path(spark, f"twice_{model}")), retail_source(spark, folder)
    run_warehouse(source, sink, model, mode="append", ids=IDS)
    star = run_warehouse(source, sink, model, mode="append", ids=IDS)
    return audit_summary(star).withColumnsRenamed({"Rule": "TableName", "Findings": "Rows"})


def _later(model: str, spark: SparkSession, folder: str) -> DataFrame:
    """Customers of odd ids are loaded first, all of them later: what each customer bought, by
    account, over the key that the fact and the dimension share."""
    source = retail_source(spark, folder)

    def half(name: str) -> DataFrame:
        df = source(name)
        return df.where("CustomerID % 2 = 1") if name == "Customer" else df

    sink = ParquetSink(new_path(spark, f"later_{model}"))
    run_warehouse(half, sink, model, mode="append", ids=IDS)
    star = run_warehouse(source, sink, model, mode="append", ids=IDS)
    name, amount = ("AccountNumber", "LineTotal") if model == "wide" else ("LastName", "SalesAmount")
    return revenue_by(star[FACT], star["DimCustomer"], "CustomerKey", [name], amount)


for _model in ("wide", "narrow"):
    QUERIES[f"warehouse_run_{_model}"] = partial(_run, _model)
    QUERIES[f"load_twice_same_rows_{_model}"] = partial(_twice, _model)
    QUERIES[f"append_later_customers_{_model}"] = partial(_later, _model)


@query
def fact_wide_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the wide fact with amounts a hundred times as large: what does not fit, by rule."""
    detail = retail_source(spark, folder)("SalesOrderDetail")
    large = detail.withColumn("LineTotal", F.col("LineTotal").cast("decimal(18,4)") * 100)
    return reject_counts(large, "wide", IDS)


def _left_mart(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue by city over the fact that keeps lines without a known address."""
    fact = fact_plan(spark, folder, "wide", geo_join="left")
    place = star_tables(spark, folder, "wide")["DimGeography"]
    by_key = fact.groupBy("GeographyKey").agg(F.sum("LineTotal").alias("part"))
    joined = by_key.join(place.select("GeographyKey", "City"), "GeographyKey", "left")
    total = F.sum("part").cast("decimal(29,4)").alias("TotalRevenue")
    return joined.groupBy("City").agg(total)


QUERIES["revenue_by_city_left"] = _left_mart


@query
def conform_temporal(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose day, time, flag and total are text, as operational tables hand them out."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    minute = F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0")
    offset = F.when(F.col("o_orderkey") % 2 == 0, F.lit(" +02:00")).otherwise(F.lit(" -05:30"))
    texts = retail_table(spark, folder, "orders").select(
        "o_orderkey",
        F.concat(day, F.lit(" 10:"), minute, F.lit(":21.5876543"), offset).alias("at"),
        F.concat(F.lit("07:"), minute, F.lit(":00.2500000")).alias("shift"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("1")).when(F.col("o_orderkey") % 3 == 1, F.lit("0"))
        .otherwise(F.lit("?")).alias("bit"),
        F.concat(F.lit("$"), F.format_number(F.col("o_totalprice").cast("decimal(15,2)"), 2)).alias("total"),
    )
    return texts.select(
        "o_orderkey",
        timestamp_of(F.col("at")).alias("OrderedAt"),
        seconds_of_day(F.col("shift")).cast("double").alias("ShiftSeconds"),
        bit_of(F.col("bit")).alias("Flag"),
        money_of(F.col("total")).alias("Total"),
    )
