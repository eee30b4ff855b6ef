"""Small frames for the cases that ordinary data rarely shows."""

from datetime import date, datetime
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F
from starloom.functions import full_name
from starloom.operators.audit import audit_cast, audit_foreign_key, audit_unique
from starloom.operators.changes import apply_changes, sparse_set, xml_fields, xml_values
from starloom.operators.marts import revenue_by, revenue_rollup
from starloom.operators.privacy import classifications, classify, masked
from starloom.operators.shape import dedupe, first_match, require_not_null
from starloom.operators.timeintel import growth, same_period_last_year
from starloom.plans import dims as D
from starloom.plans.facts import fact_narrow, fact_wide
from starloom.plans.schemas import table_schema

CUSTOMER = (
    "CustomerID int, PersonID int, StoreID int, TerritoryID int, AccountNumber string, "
    "ModifiedDate date"
)
PERSON = (
    "BusinessEntityID int, FirstName string, MiddleName string, LastName string, "
    "EmailPromotion int, ModifiedDate date"
)
PRODUCT = (
    "ProductID int, ProductSubcategoryID int, Name string, ProductNumber string, MakeFlag int, "
    "FinishedGoodsFlag int, Color string, SafetyStockLevel int, ReorderPoint int, "
    "StandardCost decimal(19,4), ListPrice decimal(19,4), Size string, SizeUnitMeasureCode string, "
    "Weight decimal(8,2), WeightUnitMeasureCode string, DaysToManufacture int, "
    "ProductLine string, Class string, Style string, ModifiedDate date"
)
HEADER = (
    "SalesOrderID int, CustomerID int, ShipToAddressID int, BillToAddressID int, "
    "OrderDate timestamp, DueDate timestamp, ShipDate timestamp, OnlineOrderFlag int, "
    "SalesOrderNumber string, ModifiedDate timestamp"
)
DETAIL = (
    "SalesOrderID int, SalesOrderDetailID int, ProductID int, OrderQty int, "
    "UnitPrice decimal(19,4), UnitPriceDiscount decimal(19,4), LineTotal decimal(38,6), "
    "CarrierTrackingNumber string, ModifiedDate timestamp"
)
DAY = date(2012, 5, 1)


def has_schema(df, model, table):
    """Names, order and types, whatever the nullability."""
    return df.schema.simpleString() == table_schema(model, table).simpleString()


def collect(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def people(spark):
    customer = spark.createDataFrame(
        [
            (30, 3, None, 1, "A3", None),  # person without middle name, two phones
            (10, 1, 7, 1, "A1", DAY),  # person without any name, no phone
            (20, None, 8, 1, "A2", DAY),  # store without a person
            (40, 4, None, 1, None, DAY),  # no account number
            (50, 5, None, 1, "A5", DAY),  # phone, but no person record
        ],
        CUSTOMER,
    )
    person = spark.createDataFrame(
        [
            (1, None, None, None, 0, DAY),
            (3, "Ann", None, "Lee", 2, date(2011, 1, 1)),
            (4, "Bo", "B", "Ray", 1, DAY),
        ],
        PERSON,
    )
    phone = spark.createDataFrame(
        [(3, "333-2"), (3, "333-1"), (4, "444"), (5, "555")],
        "BusinessEntityID int, PhoneNumber string",
    )
    return customer, person, phone


def test_wide_customers(people):
    got = D.dim_customer_wide(*people).select(
        "CustomerKey", "CustomerID", "Name", "EmailPromotion", "PhoneNumber", "ModifiedDate"
    )
    assert collect(got, "CustomerKey") == [
        (1, 10, "", False, None, DAY),
        (2, 20, "", None, None, DAY),
        (3, 30, "Ann Lee", True, "333-1", date(2011, 1, 1)),
        (5, 50, "", None, "555", DAY),  # key 4 was taken by the customer dropped since
    ]
    assert has_schema(D.dim_customer_wide(*people), "wide", "DimCustomer")


def test_uncleaned_customers_keep_all(people):
    assert D.dim_customer_wide(*people, clean=False).count() == 5


@pytest.mark.parametrize("limits", [(1_000_000, 5_000_000), (2, 1)])
def test_customers_do_not_depend_on_ranges_and_hot_keys(people, limits):
    rows_per_range, hot_rows = limits
    options = {"rows_per_range": rows_per_range, "hot_rows": hot_rows}
    assert collect(D.dim_customer_wide(*people, **options), "CustomerKey") == collect(
        D.dim_customer_wide(*people), "CustomerKey"
    )


def test_narrow_customers(spark, people):
    customer, person, _ = people
    email = spark.createDataFrame(
        [(3, "b@x"), (3, "a@x"), (5, "no person")], "BusinessEntityID int, EmailAddress string"
    )
    got = D.dim_customer_narrow(customer, person, email).drop("CustomerID")
    assert collect(got, "CustomerKey") == [
        (1, None, None, None, "Store"),
        (2, None, None, None, "Store"),
        (3, "Ann", "Lee", "a@x", "Individual"),
        (4, "Bo", "Ray", None, "Individual"),
        (5, None, None, None, "Individual"),
    ]


def test_name_of_nulls_is_empty_and_blank_middle_leaves_two_spaces(spark):
    df = spark.createDataFrame(
        [("A", None, "B"), (None, None, None)], "a string, b string, c string"
    )
    got = df.select(
        full_name("a", "b", "c").alias("x"), full_name("a", "b", "c", blank_middle=True).alias("y")
    )
    assert [tuple(r) for r in got.collect()] == [("A B", "A  B"), ("", "")]
    assert require_not_null(got, ["x"]).count() == 2


def product_row(product_id, subcategory, name="P"):
    return (product_id, subcategory, name, "N", 1, 0, None, 1, 1, Dec(1), Dec(2), *[None] * 2,
            None, None, 1, None, None, None, DAY)


@pytest.fixture(scope="module")
def goods(spark):
    product = spark.createDataFrame(
        [product_row(7, 1), product_row(5, None), product_row(6, 2), product_row(8, 1, None)],
        PRODUCT,
    )
    named = "ProductSubcategoryID int, ProductCategoryID int, Name string"
    sub = spark.createDataFrame([(1, 1, "Road"), (2, 9, "Odd")], named)
    cat = spark.createDataFrame([(1, "Wheels")], "ProductCategoryID int, Name string")
    return product, sub, cat


def test_products_with_missing_classes(goods):
    narrow = D.dim_product_narrow(*goods).drop("ProductID")
    assert collect(narrow, "ProductKey") == [
        (1, "P", "N", None, None),
        (2, "P", "N", None, "Odd"),
        (3, "P", "N", "Wheels", "Road"),
        (4, None, "N", "Wheels", "Road"),
    ]
    wide = D.dim_product_wide(*goods)
    assert collect(wide.select("ProductKey"), "ProductKey") == [(1,), (2,), (3,)]
    assert has_schema(wide, "wide", "DimProduct")


@pytest.fixture(scope="module")
def places(spark):
    address = spark.createDataFrame(
        [(4, "L", None, "X", 1, "1", DAY), (2, "L", None, "X", 99, "2", DAY),
         (3, "L", "b", "Y", 1, None, DAY)],
        "AddressID int, AddressLine1 string, AddressLine2 string, City string, "
        "StateProvinceID int, PostalCode string, ModifiedDate date",
    )
    state = spark.createDataFrame(
        [(1, "WA", "Washington", "US")],
        "StateProvinceID int, StateProvinceCode string, Name string, CountryRegionCode string",
    )
    country = spark.createDataFrame([("US", "States")], "CountryRegionCode string, Name string")
    return address, state, country


def test_geography_with_unknown_state(places):
    narrow = D.dim_geography_narrow(*places).drop("AddressID")
    assert collect(narrow, "GeographyKey") == [
        (1, "X", None, None, "2"),
        (2, "Y", "Washington", "States", None),
        (3, "X", "Washington", "States", "1"),
    ]
    assert collect(D.dim_geography_wide(*places).select("GeographyKey"), "GeographyKey") == [
        (1,),
        (3,),
    ]


def order(order_id, customer, ship, bill, when, shipped=datetime(2012, 5, 8)):
    return (order_id, customer, ship, bill, when, datetime(2012, 5, 13), shipped, 1, "S", when)


def line(order_id, line_id, product, total, qty=1):
    return (order_id, line_id, product, qty, Dec(5), Dec(0), Dec(total), None, datetime(2012, 6, 1))


@pytest.fixture(scope="module")
def sales(spark):
    header = spark.createDataFrame(
        [
            order(1, 10, 4, 4, datetime(2012, 5, 1, 10, 30)),  # not at midnight
            order(2, 20, 3, 4, datetime(2012, 5, 2), None),  # not shipped; address dropped
            order(3, 99, 4, 4, datetime(2012, 5, 3)),  # unknown customer
            order(4, 30, 4, 77, datetime(2012, 5, 4)),  # unknown bill-to address
        ],
        HEADER,
    )
    detail = spark.createDataFrame(
        [
            line(1, 1, 7, 20), line(1, 1, 7, 10), line(1, 2, 5, "12345678.5"),
            line(1, 3, 55, 1), line(2, 4, 6, 3), line(3, 5, 7, 4), line(4, 6, 7, 5),
        ],
        DETAIL,
    )
    return header, detail


@pytest.fixture(scope="module")
def wide_dims(people, goods, places, sales):
    return {
        "DimCustomer": D.dim_customer_wide(*people),
        "DimProduct": D.dim_product_wide(*goods),
        "DimGeography": D.dim_geography_wide(*places),
        "DimDate": D.dim_date_wide(*sales),
    }


SHORT = ["SalesOrderID", "SalesOrderDetailID", "CustomerKey", "ProductKey", "GeographyKey",
         "DateKey", "LineTotal", "ShipDate"]


@pytest.mark.parametrize("hot_rows", [5_000_000, 1])
def test_wide_fact(sales, wide_dims, hot_rows):
    fact = fact_wide(*sales, wide_dims, hot_rows=hot_rows)
    assert has_schema(fact, "wide", "FactCustomSales")
    # of two lines with one id the smaller total stays; the overflowing line is dropped
    shipped = date(2012, 5, 8)
    assert collect(fact.select(SHORT), "SalesOrderDetailID") == [
        (1, 1, 1, 3, 3, 20120501, Dec("10.0000"), shipped),
        (4, 6, 3, 3, 3, 20120504, Dec("5.0000"), shipped),
    ]
    left = fact_wide(*sales, wide_dims, geo_join="left", hot_rows=hot_rows)
    assert collect(left.select(SHORT), "SalesOrderDetailID")[1] == (
        2, 4, 2, 2, None, 20120502, Dec("3.0000"), None,
    )
    raw = fact_wide(*sales, wide_dims, clean=False, hot_rows=hot_rows)
    assert collect(raw.select("SalesOrderDetailID", "LineTotal"), "SalesOrderDetailID") == [
        (1, Dec("10.0000")),
        (2, None),
        (6, Dec("5.0000")),
    ]


@pytest.mark.parametrize("hot_rows", [5_000_000, 1])
def test_narrow_fact_keeps_equal_ids_and_off_midnight_orders(
    spark, people, goods, places, sales, hot_rows
):
    customer, person, _ = people
    email = spark.createDataFrame([], "BusinessEntityID int, EmailAddress string")
    dims = {
        "DimCustomer": D.dim_customer_narrow(customer, person, email),
        "DimProduct": D.dim_product_narrow(*goods),
        "DimGeography": D.dim_geography_narrow(*places),
        "DimDate": D.dim_date_narrow(sales[0]),
    }
    fact = fact_narrow(*sales, dims, hot_rows=hot_rows)
    assert has_schema(fact, "narrow", "FactCustomSales")
    assert collect(fact.select("DateKey", "ProductKey", "SalesAmount"), "SalesAmount") == [
        (20120502, 2, Dec("3.0000")),
        (20120501, 3, Dec("10.0000")),
        (20120501, 3, Dec("20.0000")),
        (20120501, 1, Dec("12345678.5000")),
    ]


def test_calendar_unites_days_without_nulls(sales):
    days = D.dim_date_wide(*sales).select("DateKey")
    assert [r[0] for r in days.orderBy("DateKey").collect()] == [
        20120501, 20120502, 20120503, 20120504, 20120508, 20120513, 20120601,
    ]


def test_fiscal_year_named_by_its_end(sales):
    got = D.dim_date_wide(*sales, fiscal_start_month=5).where("DateKey = 20120501")
    assert got.select("FiscalQuarter", "FiscalYear", "FiscalSemester").first() == (1, 2013, "H1")
    with pytest.raises(ValueError):
        D.dim_date_wide(*sales, fiscal_start_month=13)


def test_dedupe_is_the_same_for_any_input_order(spark):
    rows = [(1, 1, None), (1, 1, 5), (1, 1, 3), (1, 2, 9), (2, 1, None)]
    for order_of_rows in (rows, rows[::-1]):
        df = spark.createDataFrame(order_of_rows, "a int, b int, c int").repartition(3)
        assert collect(dedupe(df, ["a", "b"]), "a", "b") == [(1, 1, 3), (1, 2, 9), (2, 1, None)]
    assert first_match(df, ["a"], ["b", "c"]).count() == 2


def star(spark, days, sales_rows):
    dim = spark.createDataFrame(
        [(d.year * 10000 + d.month * 100 + d.day, d, d.year) for d in days],
        "DateKey int, FullDate date, Year int",
    )
    fact = spark.createDataFrame(
        [(k, Dec(v)) for k, v in sales_rows], "DateKey int, SalesAmount decimal(19,4)"
    )
    return fact, dim


def test_same_period_counts_matching_days_once(spark):
    days = [date(2011, 2, 28), date(2011, 9, 9), date(2012, 2, 28), date(2012, 2, 29),
            date(2013, 2, 28), date(2014, 1, 1)]
    sold = [(20110228, 100), (20110909, 900), (20120228, 10), (20120229, 1), (20130228, 22)]
    fact, dim = star(spark, days, sold)
    got = collect(growth(fact, dim, ["Year"]), "Year")
    assert got == [
        (2011, Dec("1000.0000"), None, None, None),
        (2012, Dec("11.0000"), Dec("100.0000"), -0.89, -89.0),
        (2013, Dec("22.0000"), Dec("10.0000"), 1.2, 120.0),  # 28 Feb 2012, not the 29th
        (2014, None, None, None, None),
    ]
    # whole calendar: the days that have a partner a year later
    total = same_period_last_year(fact, dim, []).collect()
    assert [tuple(r) for r in total] == [(Dec("1033.0000"), Dec("110.0000"))]


def test_growth_is_null_when_last_year_is_zero(spark):
    fact, dim = star(
        spark, [date(2011, 1, 1), date(2012, 1, 1)], [(20110101, 0), (20120101, 5)]
    )
    assert collect(growth(fact, dim, ["Year"]), "Year")[1][2:] == (Dec("0.0000"), None, None)


def test_total_is_null_when_a_year_has_no_sales(spark):
    fact, dim = star(spark, [date(2011, 1, 1), date(2012, 1, 1)], [(20110101, 4)])
    assert collect(growth(fact, dim, ["Year"]), "Year")[1] == (
        2012, None, Dec("4.0000"), None, None,
    )


def test_revenue_ignores_unknown_keys_and_keeps_null_attributes(spark):
    fact = spark.createDataFrame(
        [(1, Dec(5)), (2, Dec(7)), (9, Dec(1)), (None, Dec(1))], "K int, V decimal(10,4)"
    )
    dim = spark.createDataFrame([(1, "a"), (2, None)], "K int, A string")
    got = revenue_by(fact, dim, "K", ["A"], "V")
    assert collect(got, "A") == [(None, Dec("7.0000")), ("a", Dec("5.0000"))]
    rolled = revenue_rollup(fact, dim, "K", ["A"], "V")
    assert collect(rolled, "Level", "A") == [
        (None, 0, Dec("12.0000")),
        (None, 1, Dec("7.0000")),
        ("a", 1, Dec("5.0000")),
    ]


def test_sums_do_not_overflow_the_fact_type(spark):
    fact = spark.range(3).select(
        F.lit(1).alias("K"), F.lit(Dec("99999999999999.9999")).alias("V")
    )
    dim = spark.createDataFrame([(1, "a")], "K int, A string")
    assert revenue_by(fact, dim, "K", ["A"], "V").first()[1] == Dec("299999999999999.9997")


def test_audits(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "p int")
    assert collect(audit_foreign_key(child, parent, "k", "p"), "k") == [(2, 2)]
    assert collect(audit_unique(child, ["k"]), "k") == [(2, 2)]
    totals = spark.createDataFrame([(Dec("12345678.5"),), (Dec(1),), (None,)], "t decimal(19,4)")
    assert collect(audit_cast(totals, {"t": "decimal(10,4)"}), "ColumnName") == [("t", 1)]


def test_changes_apply_only_where_they_can(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    changes = spark.createDataFrame(
        [(1, "A", "U"), (2, None, "D"), (3, "C", "I"), (4, "d", "I"), (5, "e", "U"), (6, "f", "D")],
        "k int, v string, op string",
    )
    assert collect(apply_changes(target, changes, ["k"]), "k") == [(1, "A"), (3, "c"), (4, "d")]


def test_sparse_set_and_xml(spark):
    df = spark.createDataFrame(
        [(1, None, 2), (2, None, None)], "id int, FirstName string, Visits int"
    )
    sets = sparse_set(df, ["FirstName", "Visits"]).orderBy("id").collect()
    assert [r.ColumnSet for r in sets] == [{"Visits": "2"}, {}]
    xml = spark.createDataFrame([("<c><name>N &amp; M</name></c>",)], "doc string")
    assert xml_fields(xml, "doc", "name string, phone string").first() == ("N & M", None)


def test_masking_follows_the_labels(spark):
    df = spark.createDataFrame([("Ab1", "x", 5)], "n string, m string, v int")
    labelled = classify(df, {"n": ("PII", "Name"), "v": ("Secret", "Amount")})
    assert classifications(labelled) == {"n": ("PII", "Name"), "v": ("Secret", "Amount")}
    assert tuple(masked(labelled).first()) == ("Xxn", "x", None)


def test_xml_values_are_parsed_by_several_tasks(spark):
    docs = ["<a><b>1</b><c/></a>", "<a><b></b></a>", "<a/>", "<a><b>x</b><c>2</c></a>", None] * 20
    df = spark.createDataFrame(list(enumerate(docs)), "id int, doc string").coalesce(1)
    found = xml_values(df, "doc", {"b": "/a/b", "c": "/a/c", "n": "count(/a/b)"})
    assert found.rdd.getNumPartitions() > 1
    want = [("1", "", "1"), ("", None, "1"), (None, None, None), ("x", "2", "1"), (None, None, None)]
    for r in found.collect():
        n = r.n and str(int(float(r.n)))
        assert (r.b, r.c, n) == want[r.id % 5]
