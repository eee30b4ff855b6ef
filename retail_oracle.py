"""The registered queries in SQL, for a check by DuckDB over the same Parquet tables."""

from __future__ import annotations

# Each common table expression: name -> (those it reads, its text).
CTES: dict[str, tuple[list[str], str]] = {}
SQL: dict[str, str] = {}


def cte(name: str, text: str, *needs: str) -> None:
    CTES[name] = (list(needs), text)


def sql(name: str, text: str, *needs: str) -> None:
    chosen: dict[str, None] = {}

    def add(n: str) -> None:
        for other in CTES[n][0]:
            add(other)
        chosen[n] = None

    for n in needs:
        add(n)
    head = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in chosen)
    SQL[name] = f"WITH {head}\n{text}" if head else text


# --- source tables -------------------------------------------------------------------------

cte(
    "customer_src",
    """SELECT c_custkey AS CustomerID,
    CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS PersonID,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_custkey END AS StoreID,
    c_nationkey AS TerritoryID,
    'AC' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS AccountNumber,
    CASE WHEN c_custkey % 11 <> 0
        THEN DATE '1995-01-01' + CAST(c_custkey % 1000 AS INTEGER) END AS ModifiedDate
    FROM customer""",
)
cte(
    "person_src",
    """SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_custkey ELSE -c_custkey END AS BusinessEntityID,
    split_part(c_name, '#', 1) AS FirstName,
    CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS MiddleName,
    split_part(c_name, '#', 2) AS LastName,
    CAST(c_custkey % 3 AS INTEGER) AS EmailPromotion,
    DATE '1996-01-01' + CAST(c_custkey % 500 AS INTEGER) AS ModifiedDate
    FROM customer""",
)
cte(
    "person_phone_src",
    """SELECT c_custkey AS BusinessEntityID,
    '1-' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS PhoneNumber FROM customer
    UNION ALL
    SELECT c_custkey, '2-' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') FROM customer
    WHERE c_custkey % 5 = 0""",
)
cte(
    "email_address_src",
    """SELECT c_custkey AS BusinessEntityID,
    'a' || CAST(c_custkey AS VARCHAR) || '@example.com' AS EmailAddress FROM customer
    UNION ALL
    SELECT c_custkey, 'b' || CAST(c_custkey AS VARCHAR) || '@example.com' FROM customer
    WHERE c_custkey % 5 = 0""",
)
cte(
    "product_src",
    """SELECT p_partkey AS ProductID,
    CASE WHEN p_size % 10 <> 0 THEN p_brand END AS ProductSubcategoryID,
    p_name AS Name,
    'PN-' || CAST(p_partkey AS VARCHAR) AS ProductNumber,
    p_size % 2 AS MakeFlag,
    p_size % 3 AS FinishedGoodsFlag,
    CASE WHEN p_size % 4 <> 0 THEN split_part(p_name, ' ', 1) END AS Color,
    p_size * 10 AS SafetyStockLevel,
    p_size * 5 AS ReorderPoint,
    CAST(CAST(p_retailprice AS DECIMAL(15,2)) * CAST('0.6' AS DECIMAL(2,1)) AS DECIMAL(18,3))
        AS StandardCost,
    CAST(p_retailprice AS DECIMAL(15,2)) AS ListPrice,
    CAST(p_size AS VARCHAR) AS Size,
    CASE WHEN p_size % 2 = 0 THEN 'CM' END AS SizeUnitMeasureCode,
    CAST(CAST(p_size AS DECIMAL(10,0)) * CAST('1.25' AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS Weight,
    CASE WHEN p_size % 3 = 0 THEN 'LB' END AS WeightUnitMeasureCode,
    p_size % 5 AS DaysToManufacture,
    substr(p_type, 1, 1) AS ProductLine,
    CASE WHEN p_size % 7 = 0 THEN 'H' END AS Class,
    CASE WHEN p_size % 6 = 0 THEN 'U' END AS Style,
    DATE '1994-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS ModifiedDate
    FROM part""",
)
cte(
    "product_subcategory_src",
    """SELECT DISTINCT p_brand AS ProductSubcategoryID,
    CAST(substr(p_brand, 7) AS INTEGER) % 4 AS ProductCategoryID,
    'Sub ' || p_brand AS Name FROM part""",
)
cte(
    "product_category_src",
    """SELECT CASE WHEN r_regionkey < 3 THEN r_regionkey ELSE r_regionkey + 100 END
    AS ProductCategoryID, 'Cat ' || r_name AS Name FROM region""",
)
cte(
    "address_src",
    """SELECT AddressID, AddressLine1,
    CASE WHEN k % 3 = 0 THEN 'Unit ' || CAST(k AS VARCHAR) END AS AddressLine2,
    'City ' || CAST(k % 97 AS VARCHAR) AS City,
    CASE WHEN k % 17 <> 0 THEN n END AS StateProvinceID,
    CASE WHEN k % 19 <> 0 THEN lpad(CAST(k % 100000 AS VARCHAR), 5, '0') END AS PostalCode,
    DATE '1993-01-01' + CAST(k % 700 AS INTEGER) AS ModifiedDate
    FROM (
        SELECT c_custkey * 2 AS AddressID, c_custkey AS k, c_name AS AddressLine1,
            c_nationkey AS n FROM customer
        UNION ALL
        SELECT s_suppkey * 2 + 1, s_suppkey, s_name, s_nationkey FROM supplier
    )""",
)
cte(
    "state_province_src",
    """SELECT n_nationkey AS StateProvinceID, 'N' || CAST(n_nationkey AS VARCHAR)
    AS StateProvinceCode, n_name AS Name, 'R' || CAST(n_regionkey AS VARCHAR) AS CountryRegionCode
    FROM nation""",
)
cte(
    "country_region_src",
    """SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS CountryRegionCode, r_name AS Name
    FROM region""",
)
cte(
    "sales_order_header_src",
    """SELECT o_orderkey AS SalesOrderID, o_custkey AS CustomerID,
    o_custkey * 2 AS BillToAddressID, o_orderdate AS OrderDate,
    CAST(o_orderdate AS DATE) + 12 AS DueDate,
    CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 7 END AS ShipDate,
    CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS OnlineOrderFlag,
    'SO' || CAST(o_orderkey AS VARCHAR) AS SalesOrderNumber,
    CAST(o_orderdate AS DATE) + 7 AS ModifiedDate
    FROM orders""",
)
cte(
    "sales_order_detail_src",
    """SELECT l_orderkey AS SalesOrderID, l_linenumber AS SalesOrderDetailID,
    l_partkey AS ProductID, l_suppkey * 2 + 1 AS ShipToAddressID, l_quantity AS OrderQty,
    CAST(l_extendedprice AS DECIMAL(15,2)) AS UnitPrice,
    CAST(l_discount AS DECIMAL(15,2)) AS UnitPriceDiscount,
    CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2)))
        AS DECIMAL(32,4)) AS LineTotal,
    CASE WHEN l_returnflag <> 'N' THEN l_returnflag || l_linestatus END AS CarrierTrackingNumber,
    l_shipdate AS ModifiedDate
    FROM lineitem""",
)
for _src in [n for n in CTES if n.endswith("_src")]:
    sql("scan_" + _src.removesuffix("_src"), f"SELECT * FROM {_src}", _src)

sql(
    "preview_sales_order_header",
    "SELECT * FROM sales_order_header_src ORDER BY SalesOrderID LIMIT 5",
    "sales_order_header_src",
)
sql("scan_tab_separated", "SELECT * FROM customer_src", "customer_src")
sql("scan_multi_line_records", "SELECT doc_id, n_chars, text FROM documents")
SQL["scan_records_with_tabs"] = (
    "SELECT doc_id, n_chars, text || chr(9) || 'after a tab' || chr(10) || 'and a line' || chr(9) "
    "|| 'to its end' AS text FROM documents"
)
SQL["scan_reject_counts"] = """SELECT CASE WHEN l_orderkey % 7 = 0 THEN '4 fields'
    WHEN l_orderkey % 5 = 0 THEN 'l_linenumber is not int' ELSE 'read' END AS Outcome,
    count(*) AS "Rows" FROM lineitem GROUP BY 1"""

# --- dimensions ----------------------------------------------------------------------------

cte(
    "phone1",
    "SELECT BusinessEntityID, min(PhoneNumber) AS PhoneNumber FROM person_phone_src GROUP BY 1",
    "person_phone_src",
)
cte(
    "email1",
    "SELECT BusinessEntityID, min(EmailAddress) AS EmailAddress FROM email_address_src GROUP BY 1",
    "email_address_src",
)
cte(
    "customer_all",
    """SELECT c.CustomerKey, c.CustomerID, c.PersonID, c.StoreID, c.TerritoryID, c.AccountNumber,
    concat_ws(' ', p.FirstName, p.MiddleName, p.LastName) AS Name,
    CAST(p.EmailPromotion AS BOOLEAN) AS EmailPromotion, f.PhoneNumber,
    coalesce(c.ModifiedDate, p.ModifiedDate) AS ModifiedDate
    FROM (SELECT row_number() OVER (ORDER BY CustomerID) AS CustomerKey, * FROM customer_src) c
    LEFT JOIN person_src p ON c.PersonID = p.BusinessEntityID
    LEFT JOIN phone1 f ON c.PersonID = f.BusinessEntityID""",
    "customer_src", "person_src", "phone1",
)
cte(
    "customer_wide",
    """SELECT * FROM customer_all WHERE AccountNumber IS NOT NULL AND Name IS NOT NULL
    AND ModifiedDate IS NOT NULL""",
    "customer_all",
)
cte(
    "customer_narrow",
    """SELECT c.CustomerKey, c.CustomerID, p.FirstName, p.LastName, e.EmailAddress,
    CASE WHEN c.StoreID IS NOT NULL THEN 'Store' ELSE 'Individual' END AS CustomerType
    FROM (SELECT row_number() OVER (ORDER BY CustomerID) AS CustomerKey, * FROM customer_src) c
    LEFT JOIN person_src p ON c.PersonID = p.BusinessEntityID
    LEFT JOIN email1 e ON p.BusinessEntityID = e.BusinessEntityID""",
    "customer_src", "person_src", "email1",
)
cte(
    "product_all",
    """SELECT row_number() OVER (ORDER BY p.ProductID) AS ProductKey, p.ProductID, p.Name,
    p.ProductNumber, CAST(p.MakeFlag AS BOOLEAN) AS MakeFlag,
    CAST(p.FinishedGoodsFlag AS BOOLEAN) AS FinishedGoodsFlag, p.Color, p.SafetyStockLevel,
    p.ReorderPoint, CAST(p.StandardCost AS DECIMAL(10,4)) AS StandardCost,
    CAST(p.ListPrice AS DECIMAL(10,4)) AS ListPrice, p.Size, p.SizeUnitMeasureCode,
    CAST(p.Weight AS DECIMAL(10,2)) AS Weight, p.WeightUnitMeasureCode, p.DaysToManufacture,
    p.ProductLine, p.Class, p.Style, c.Name AS ProductCategoryName,
    s.Name AS ProductSubcategoryName, p.ModifiedDate
    FROM product_src p
    LEFT JOIN product_subcategory_src s ON p.ProductSubcategoryID = s.ProductSubcategoryID
    LEFT JOIN product_category_src c ON s.ProductCategoryID = c.ProductCategoryID""",
    "product_src", "product_subcategory_src", "product_category_src",
)
cte(
    "geography_all",
    """SELECT row_number() OVER (ORDER BY a.AddressID) AS GeographyKey, a.AddressID,
    a.AddressLine1, a.AddressLine2, a.City, s.StateProvinceCode, s.Name AS StateProvinceName,
    s.CountryRegionCode, c.Name AS CountryRegionName, a.PostalCode, a.ModifiedDate
    FROM address_src a
    LEFT JOIN state_province_src s ON a.StateProvinceID = s.StateProvinceID
    LEFT JOIN country_region_src c ON s.CountryRegionCode = c.CountryRegionCode""",
    "address_src", "state_province_src", "country_region_src",
)
cte(
    "geography_wide",
    """SELECT * FROM geography_all WHERE AddressLine1 IS NOT NULL AND City IS NOT NULL
    AND PostalCode IS NOT NULL AND ModifiedDate IS NOT NULL""",
    "geography_all",
)
cte(
    "days",
    """SELECT DISTINCT d FROM (
        SELECT CAST(OrderDate AS DATE) AS d FROM sales_order_header_src
        UNION ALL SELECT DueDate FROM sales_order_header_src
        UNION ALL SELECT ShipDate FROM sales_order_header_src
        UNION ALL SELECT CAST(ModifiedDate AS DATE) FROM sales_order_detail_src
    ) WHERE d IS NOT NULL""",
    "sales_order_header_src", "sales_order_detail_src",
)

DATE_KEY = "CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"
CALENDAR = """CAST(day({d}) AS INTEGER) AS DayNumberOfMonth,
    dayname({d}) AS DayNameOfWeek,
    CAST(dayofweek({d}) + 1 AS INTEGER) AS DayNumberOfWeek,
    CAST(dayofyear({d}) AS INTEGER) AS DayNumberOfYear,
    CAST(weekofyear({d}) AS INTEGER) AS WeekNumberOfYear,
    CAST(month({d}) AS INTEGER) AS MonthNumberOfYear,
    monthname({d}) AS MonthName,
    CAST(quarter({d}) AS INTEGER) AS QuarterNumberOfYear,
    'Q ' || CAST(quarter({d}) AS VARCHAR) AS QuarterName,
    CAST(year({d}) AS INTEGER) AS CalendarYear,
    CASE WHEN quarter({d}) <= 2 THEN 'H1' ELSE 'H2' END AS CalendarSemester"""


def fiscal(day: str, months: int) -> str:
    moved = f"({day} + INTERVAL {months} MONTH)"
    return f"""CAST(quarter({moved}) AS INTEGER) AS FiscalQuarter,
    CAST(year({moved}) AS INTEGER) AS FiscalYear,
    CASE WHEN quarter({moved}) <= 2 THEN 'H1' ELSE 'H2' END AS FiscalSemester"""


def wide_calendar(months: int) -> str:
    return f"""SELECT {DATE_KEY.format(d="d")} AS DateKey, d AS FullDateAlternateKey,
    {CALENDAR.format(d="d")}, {fiscal("d", months)}, d AS ModifiedDate FROM days"""


cte("date_wide", wide_calendar(0), "days")
cte(
    "date_narrow",
    f"""SELECT {DATE_KEY.format(d="d")} AS DateKey, d AS FullDate,
    CAST(year(d) AS INTEGER) AS Year, CAST(month(d) AS INTEGER) AS Month,
    monthname(d) AS MonthName, CAST(quarter(d) AS INTEGER) AS Quarter
    FROM (SELECT DISTINCT CAST(OrderDate AS DATE) AS d FROM sales_order_header_src)""",
    "sales_order_header_src",
)

sql("dim_customer_wide", "SELECT * FROM customer_wide", "customer_wide")
sql("dim_customer_wide_uncleaned", "SELECT * FROM customer_all", "customer_all")
sql("dim_customer_narrow", "SELECT * EXCLUDE (CustomerID) FROM customer_narrow", "customer_narrow")
sql(
    "dim_product_wide",
    """SELECT * FROM product_all WHERE ProductID IS NOT NULL AND Name IS NOT NULL
    AND ProductNumber IS NOT NULL AND StandardCost IS NOT NULL AND ListPrice IS NOT NULL
    AND ModifiedDate IS NOT NULL""",
    "product_all",
)
sql(
    "dim_product_narrow",
    """SELECT ProductKey, Name AS ProductName, ProductNumber,
    ProductCategoryName AS ProductCategory, ProductSubcategoryName AS ProductSubcategory
    FROM product_all""",
    "product_all",
)
sql("dim_geography_wide", "SELECT * FROM geography_wide", "geography_wide")
sql(
    "dim_geography_narrow",
    """SELECT GeographyKey, City, StateProvinceName AS StateProvince,
    CountryRegionName AS CountryRegion, PostalCode FROM geography_all""",
    "geography_all",
)
sql("dim_date_wide", "SELECT * FROM date_wide", "date_wide")
sql("dim_date_wide_fiscal_july", wide_calendar(6), "days")
sql("dim_date_narrow", "SELECT * FROM date_narrow", "date_narrow")
sql(
    "distinct_days",
    'SELECT d AS "Day" FROM days UNION SELECT CAST(ts AS DATE) FROM events WHERE ts IS NOT NULL',
    "days",
)
sql(
    "union_all_days",
    """SELECT d AS "Day", count(*) AS "Rows" FROM (
        SELECT CAST(OrderDate AS DATE) AS d FROM sales_order_header_src
        UNION ALL SELECT DueDate FROM sales_order_header_src
        UNION ALL SELECT ShipDate FROM sales_order_header_src
        UNION ALL SELECT CAST(ModifiedDate AS DATE) FROM sales_order_detail_src
    ) GROUP BY 1""",
    "sales_order_header_src", "sales_order_detail_src",
)
sql(
    "surrogate_key_orders",
    """SELECT row_number() OVER (ORDER BY o_orderkey) AS OrderKey, o_orderkey AS SalesOrderID
    FROM orders""",
)
sql(
    "surrogate_key_text",
    """SELECT row_number() OVER (ORDER BY EmailAddress) AS MailKey, BusinessEntityID, EmailAddress
    FROM email_address_src""",
    "email_address_src",
)

# --- joins ---------------------------------------------------------------------------------

sql(
    "lookup_customer_person",
    """SELECT CustomerID, PersonID, p.LastName AS PersonLastName,
    p.ModifiedDate AS PersonModifiedDate
    FROM customer_src c LEFT JOIN person_src p ON c.PersonID = p.BusinessEntityID""",
    "customer_src", "person_src",
)
sql(
    "lookup_customer_all_phones",
    """SELECT CustomerID, PersonID, PhoneNumber
    FROM customer_src c LEFT JOIN person_phone_src p ON c.PersonID = p.BusinessEntityID""",
    "customer_src", "person_phone_src",
)
sql(
    "lookup_person_all_emails",
    """SELECT p.BusinessEntityID, LastName, EmailAddress
    FROM person_src p LEFT JOIN email_address_src e ON p.BusinessEntityID = e.BusinessEntityID""",
    "person_src", "email_address_src",
)
sql(
    "lookup_product_category",
    """SELECT ProductID, p.ProductSubcategoryID, s.Name AS SubcategoryName, s.ProductCategoryID,
    c.Name AS CategoryName FROM product_src p
    LEFT JOIN product_subcategory_src s ON p.ProductSubcategoryID = s.ProductSubcategoryID
    LEFT JOIN product_category_src c ON s.ProductCategoryID = c.ProductCategoryID""",
    "product_src", "product_subcategory_src", "product_category_src",
)
sql(
    "lookup_address_country",
    """SELECT AddressID, a.StateProvinceID, s.Name AS StateName, s.CountryRegionCode,
    c.Name AS CountryName FROM address_src a
    LEFT JOIN state_province_src s ON a.StateProvinceID = s.StateProvinceID
    LEFT JOIN country_region_src c ON s.CountryRegionCode = c.CountryRegionCode""",
    "address_src", "state_province_src", "country_region_src",
)
sql(
    "join_header_detail",
    """SELECT h.SalesOrderID, d.SalesOrderDetailID, d.LineTotal,
    h.ModifiedDate AS HeaderModifiedDate
    FROM sales_order_header_src h JOIN sales_order_detail_src d
    ON h.SalesOrderID = d.SalesOrderID""",
    "sales_order_header_src", "sales_order_detail_src",
)

# --- facts ---------------------------------------------------------------------------------


def wide_fact(role: str = "d.ShipToAddressID", kind: str = "JOIN") -> str:
    """The line kept among those with equal ids is the first by the lines' own columns."""
    place = "" if kind == "JOIN" else "--"
    return f"""SELECT * EXCLUDE (place) FROM (
    SELECT c.CustomerKey, p.ProductKey, g.GeographyKey, t.DateKey, h.SalesOrderID,
    CAST(d.SalesOrderDetailID AS BIGINT) AS SalesOrderDetailID,
    CAST(d.OrderQty AS INTEGER) AS OrderQty,
    TRY_CAST(d.UnitPrice AS DECIMAL(10,4)) AS UnitPrice,
    TRY_CAST(d.UnitPriceDiscount AS DECIMAL(10,4)) AS UnitPriceDiscount,
    TRY_CAST(d.LineTotal AS DECIMAL(10,4)) AS LineTotal,
    CAST(h.OrderDate AS DATE) AS OrderDate, h.DueDate, h.ShipDate,
    CAST(h.OnlineOrderFlag AS BOOLEAN) AS OnlineOrderFlag, h.SalesOrderNumber,
    d.CarrierTrackingNumber, h.ModifiedDate,
    row_number() OVER (PARTITION BY d.SalesOrderID, d.SalesOrderDetailID
        ORDER BY (d.OrderQty IS NULL OR TRY_CAST(d.UnitPrice AS DECIMAL(10,4)) IS NULL
            OR TRY_CAST(d.LineTotal AS DECIMAL(10,4)) IS NULL),
        d.OrderQty NULLS LAST, d.UnitPrice NULLS LAST, d.UnitPriceDiscount NULLS LAST,
        d.LineTotal NULLS LAST, d.CarrierTrackingNumber NULLS LAST, p.ProductKey NULLS LAST,
        g.GeographyKey NULLS LAST) AS place
    FROM sales_order_header_src h
    JOIN sales_order_detail_src d ON h.SalesOrderID = d.SalesOrderID
    JOIN customer_wide c ON h.CustomerID = c.CustomerID
    JOIN product_all p ON d.ProductID = p.ProductID
    {kind} geography_wide g ON {role} = g.AddressID
    JOIN date_wide t ON {DATE_KEY.format(d="h.OrderDate")} = t.DateKey
    ) WHERE place = 1 AND OrderQty IS NOT NULL AND UnitPrice IS NOT NULL AND LineTotal IS NOT NULL
    {place} AND GeographyKey IS NOT NULL
    """


WIDE_NEEDS = (
    "sales_order_header_src", "sales_order_detail_src", "customer_wide", "product_all",
    "geography_wide", "date_wide",
)


def narrow_fact(role: str) -> str:
    return f"""SELECT c.CustomerKey, p.ProductKey, g.GeographyKey, t.DateKey,
    CAST(d.OrderQty AS SMALLINT) AS OrderQuantity,
    CAST(d.LineTotal AS DECIMAL(19,4)) AS SalesAmount,
    CAST(d.UnitPrice AS DECIMAL(19,4)) AS UnitPrice
    FROM sales_order_detail_src d
    JOIN sales_order_header_src h ON d.SalesOrderID = h.SalesOrderID
    JOIN customer_narrow c ON h.CustomerID = c.CustomerID
    JOIN product_all p ON d.ProductID = p.ProductID
    JOIN geography_all g ON {role} = g.AddressID
    JOIN date_narrow t ON CAST(h.OrderDate AS DATE) = t.FullDate"""


NARROW_NEEDS = (
    "sales_order_header_src", "sales_order_detail_src", "customer_narrow", "product_all",
    "geography_all", "date_narrow",
)
cte("fact_w", wide_fact(), *WIDE_NEEDS)
cte("fact_n", narrow_fact("h.BillToAddressID"), *NARROW_NEEDS)
sql("fact_wide", "SELECT * FROM fact_w", "fact_w")
sql("fact_wide_hot_orders", "SELECT * FROM fact_w", "fact_w")
sql("fact_wide_left", wide_fact(kind="LEFT JOIN"), *WIDE_NEEDS)
sql("fact_wide_bill", wide_fact("h.BillToAddressID"), *WIDE_NEEDS)
sql("fact_narrow", "SELECT * FROM fact_n", "fact_n")
sql("fact_narrow_ship", narrow_fact("d.ShipToAddressID"), *NARROW_NEEDS)

# --- expressions and rules -----------------------------------------------------------------

sql(
    "name_concat",
    """SELECT BusinessEntityID, concat_ws(' ', FirstName, MiddleName, LastName) AS Name,
    concat_ws(' ', FirstName, coalesce(MiddleName, ''), LastName) AS SpacedName
    FROM person_src""",
    "person_src",
)
sql(
    "customer_types",
    """SELECT CustomerID, CASE WHEN StoreID IS NOT NULL THEN 'Store' ELSE 'Individual' END
    AS CustomerType FROM customer_src""",
    "customer_src",
)
sql(
    "modified_date_coalesce",
    """SELECT CustomerID, coalesce(c.ModifiedDate, p.ModifiedDate) AS ModifiedDate
    FROM customer_src c LEFT JOIN person_src p ON c.PersonID = p.BusinessEntityID""",
    "customer_src", "person_src",
)
sql(
    "date_parts",
    f"""SELECT event_id, CAST(ts AS DATE) AS "Day", {CALENDAR.format(d="ts")} FROM events""",
)
sql(
    "smart_date_key",
    f"SELECT o_orderkey AS SalesOrderID, {DATE_KEY.format(d='o_orderdate')} AS OrderDateKey "
    "FROM orders",
)
sql("fiscal_calendar", f"SELECT event_id, {fiscal('CAST(ts AS DATE)', 3)} FROM events")
PLANTED = """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
    nullif(o_orderpriority, '5-LOW') AS priority, CAST(o_orderdate AS DATE) AS day FROM orders"""
sql(
    "required_not_null",
    f"SELECT * FROM ({PLANTED}) WHERE status IS NOT NULL AND priority IS NOT NULL",
)
sql(
    "conform_types",
    """SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
    CAST(l_quantity AS INTEGER) AS l_quantity,
    CAST(l_extendedprice AS DECIMAL(19,4)) AS l_extendedprice,
    CAST(l_discount AS DECIMAL(10,4)) AS l_discount, CAST(l_tax AS DECIMAL(10,2)) AS l_tax,
    CAST(l_shipdate AS DATE) AS l_shipdate, l_returnflag, l_linestatus = 'O' AS open
    FROM lineitem""",
)
LARGE = """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(15,2)) * 10 AS total,
    o_custkey AS quantity FROM orders"""
sql(
    "tolerant_casts",
    f"""SELECT o_orderkey, TRY_CAST(total AS DECIMAL(10,4)) AS total,
    TRY_CAST(quantity AS TINYINT) AS quantity FROM ({LARGE})""",
)
sql(
    "dedupe_order_line",
    """SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (
        PARTITION BY SalesOrderID, SalesOrderDetailID ORDER BY ProductID NULLS LAST,
        ShipToAddressID NULLS LAST, OrderQty NULLS LAST, UnitPrice NULLS LAST,
        UnitPriceDiscount NULLS LAST, LineTotal NULLS LAST, CarrierTrackingNumber NULLS LAST,
        ModifiedDate NULLS LAST) AS place FROM sales_order_detail_src) WHERE place = 1""",
    "sales_order_detail_src",
)
sql("first_phone", "SELECT * FROM phone1", "phone1")

# --- reports -------------------------------------------------------------------------------

SUM = "CAST(sum({m}) AS DECIMAL(29,4))"
TOTAL_W = SUM.format(m="LineTotal")
TOTAL_N = SUM.format(m="SalesAmount")
sql(
    "revenue_by_category",
    f"""SELECT ProductCategoryName, {TOTAL_W} AS TotalRevenue
    FROM fact_w JOIN product_all USING (ProductKey) GROUP BY 1 ORDER BY 2 DESC""",
    "fact_w",
)
sql(
    "revenue_by_city",
    f"""SELECT City, {TOTAL_W} AS TotalRevenue
    FROM fact_w JOIN geography_wide USING (GeographyKey) GROUP BY 1 ORDER BY 2 DESC, 1""",
    "fact_w",
)
SQL["sink_roundtrip_csv"] = SQL["revenue_by_city"]
sql(
    "revenue_by_year",
    f"""SELECT CalendarYear, {TOTAL_W} AS TotalRevenue
    FROM fact_w JOIN date_wide USING (DateKey) GROUP BY 1 ORDER BY 1""",
    "fact_w",
)
sql(
    "top_cities",
    f"""SELECT City, {TOTAL_N} AS TotalSales FROM fact_n JOIN geography_all USING (GeographyKey)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "fact_n",
)
sql(
    "sales_by_category",
    f"""SELECT ProductCategoryName AS ProductCategory, {TOTAL_N} AS TotalSales
    FROM fact_n JOIN product_all USING (ProductKey) GROUP BY 1 ORDER BY 2 DESC""",
    "fact_n",
)
sql(
    "sales_by_date",
    f"""SELECT FullDate, {TOTAL_N} AS TotalSales FROM fact_n JOIN date_narrow USING (DateKey)
    GROUP BY 1 ORDER BY 1""",
    "fact_n",
)
sql(
    "sales_by_customer_type",
    f"""SELECT CustomerType, {TOTAL_N} AS TotalSales
    FROM fact_n JOIN customer_narrow USING (CustomerKey) GROUP BY 1""",
    "fact_n",
)
sql(
    "sales_by_country",
    f"""SELECT CountryRegionName AS CountryRegion, {TOTAL_N} AS TotalSales
    FROM fact_n JOIN geography_all USING (GeographyKey) GROUP BY 1""",
    "fact_n",
)
sql(
    "sales_by_state",
    f"""SELECT CountryRegionName AS CountryRegion, StateProvinceName AS StateProvince,
    {TOTAL_N} AS TotalSales FROM fact_n JOIN geography_all USING (GeographyKey) GROUP BY 1, 2""",
    "fact_n",
)
sql(
    "sales_by_place",
    f"""SELECT CountryRegionName AS CountryRegion, StateProvinceName AS StateProvince, City,
    {TOTAL_N} AS TotalSales FROM fact_n JOIN geography_all USING (GeographyKey)
    GROUP BY 1, 2, 3""",
    "fact_n",
)
sql(
    "sales_by_geo_rollup",
    f"""SELECT CountryRegion, StateProvince, City,
    CAST(3 - grouping(CountryRegion) - grouping(StateProvince) - grouping(City) AS INTEGER)
        AS Level,
    {TOTAL_N} AS TotalSales
    FROM (SELECT SalesAmount, CountryRegionName AS CountryRegion,
        StateProvinceName AS StateProvince, City
        FROM fact_n JOIN geography_all USING (GeographyKey))
    GROUP BY ROLLUP (CountryRegion, StateProvince, City)""",
    "fact_n",
)
sql("total_sales", f"SELECT {TOTAL_N} AS TotalSales FROM fact_n", "fact_n")

cte(
    "day_sales",
    """SELECT FullDate AS d, sum(SalesAmount) AS Amount
    FROM fact_n JOIN date_narrow USING (DateKey) GROUP BY 1""",
    "fact_n",
)


def periods(context: list[str], growth: bool) -> str:
    names = ", ".join(f'"{c}"' for c in context)
    lead = names + ", " if names else ""
    group = f"GROUP BY {names}" if names else ""
    match = " AND ".join(f'n."{c}" = b."{c}"' for c in context) or "TRUE"
    shown = ", ".join(f'n."{c}"' for c in context)
    shown = shown + ", " if shown else ""
    rate = "CAST(TotalSales - SalesLastYear AS DOUBLE) / CAST(SalesLastYear AS DOUBLE)"
    rate = f"CASE WHEN SalesLastYear IS NOT NULL AND SalesLastYear <> 0 THEN {rate} END"
    extra = f", {rate} AS GrowthRate, round(({rate}) * 100, 2) AS GrowthPct" if growth else ""
    return f"""SELECT *{extra} FROM (
    SELECT {shown}n.TotalSales, b.SalesLastYear FROM
    (SELECT {lead}CAST(sum(Amount) AS DECIMAL(29,4)) AS TotalSales
        FROM date_narrow LEFT JOIN day_sales ON FullDate = d {group}) n
    LEFT JOIN
    (SELECT {lead}CAST(sum(Amount) AS DECIMAL(29,4)) AS SalesLastYear
        FROM (SELECT DISTINCT {lead}CAST(FullDate - INTERVAL 12 MONTH AS DATE) AS earlier
              FROM date_narrow) LEFT JOIN day_sales ON earlier = d {group}) b ON {match})"""


for _name, _context, _growth in [
    ("sales_last_year", ["Year"], False),
    ("growth_global", [], True),
    ("growth_by_year", ["Year"], True),
    ("growth_by_quarter", ["Year", "Quarter"], True),
    ("growth_by_month", ["Year", "Month"], True),
    ("growth_by_date", ["FullDate"], True),
]:
    sql(_name, periods(_context, _growth), "date_narrow", "day_sales")

# --- audits --------------------------------------------------------------------------------


def union(rows: list[str]) -> str:
    return "\nUNION ALL\n".join(rows)


def duplicates(table: str, key: str) -> str:
    return f"SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1"


NARROW_TABLES = [
    ("DimCustomer", "customer_narrow", "CustomerKey"),
    ("DimProduct", "product_all", "ProductKey"),
    ("DimGeography", "geography_all", "GeographyKey"),
    ("DimDate", "date_narrow", "DateKey"),
]
sql(
    "audit_primary_key",
    union(
        f"SELECT '{name}' AS \"Rule\", count(*) AS Findings FROM ({duplicates(table, key)})"
        for name, table, key in NARROW_TABLES
    ),
    "customer_narrow", "product_all", "geography_all", "date_narrow",
)
sql(
    "audit_order_line_key",
    """SELECT SalesOrderID, SalesOrderDetailID, count(*) AS "Rows" FROM sales_order_detail_src
    GROUP BY 1, 2 HAVING count(*) > 1""",
    "sales_order_detail_src",
)
sql(
    "audit_fact_key",
    """SELECT CustomerKey, ProductKey, GeographyKey, DateKey, count(*) AS "Rows" FROM fact_n
    GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""",
    "fact_n",
)
sql(
    "audit_foreign_key",
    union(
        f"SELECT '{key}' AS \"Rule\", count(DISTINCT f.{key}) AS Findings FROM fact_n f "
        f"WHERE f.{key} NOT IN (SELECT {key} FROM {table})"
        for _, table, key in NARROW_TABLES
    ),
    "fact_n",
)
sql(
    "audit_foreign_key_cleaned",
    """SELECT CustomerKey, count(*) AS "Rows" FROM fact_n
    WHERE CustomerKey NOT IN (SELECT CustomerKey FROM customer_wide) GROUP BY 1""",
    "fact_n", "customer_wide",
)
FACT_COLUMNS = [
    "CustomerKey", "ProductKey", "GeographyKey", "DateKey", "OrderQuantity", "SalesAmount",
    "UnitPrice",
]


def null_counts(table: str, columns: list[str]) -> str:
    return union(
        f"SELECT '{c}' AS ColumnName, count(*) FILTER ({c} IS NULL) AS NullRows FROM {table}"
        for c in columns
    )


sql("audit_not_null", null_counts("fact_n", FACT_COLUMNS), "fact_n")
LENGTHS = [("FirstName", 50), ("LastName", 50), ("EmailAddress", 14), ("CustomerType", 15)]
sql("audit_nulls_planted", null_counts(f"({PLANTED})", ["status", "priority", "day"]))
sql(
    "audit_length",
    union(
        f"SELECT '{c}' AS ColumnName, count(*) FILTER (length({c}) > {n}) AS TooLong "
        "FROM customer_narrow"
        for c, n in LENGTHS
    ),
    "customer_narrow",
)
sql(
    "audit_range",
    """SELECT 'OrderQty' AS ColumnName, count(*) FILTER (OrderQty NOT BETWEEN 1 AND 45)
    AS OutOfRange FROM sales_order_detail_src
    UNION ALL SELECT 'SalesOrderDetailID',
    count(*) FILTER (SalesOrderDetailID NOT BETWEEN -32768 AND 32767)
    FROM sales_order_detail_src""",
    "sales_order_detail_src",
)
sql(
    "audit_cast",
    union(
        f"SELECT '{c}' AS ColumnName, count(*) FILTER ({c} IS NOT NULL AND "
        f"TRY_CAST({c} AS {t}) IS NULL) AS Rejected FROM ({LARGE})"
        for c, t in [("total", "DECIMAL(10,4)"), ("quantity", "TINYINT")]
    ),
)

# --- changes, privacy, semi-structured columns ---------------------------------------------

sql(
    "apply_changes",
    """SELECT c_custkey, CASE WHEN c_custkey % 10 = 1 THEN 'New ' || c_name ELSE c_name END
        AS c_name, CASE WHEN c_custkey % 10 <> 1 THEN c_nationkey END AS c_nationkey
    FROM customer WHERE c_custkey % 10 <> 0
    UNION ALL
    SELECT -c_custkey - 1, 'New ' || c_name, c_nationkey FROM customer WHERE c_custkey % 10 = 2""",
)
sql("append_new_rows", "SELECT * FROM customer_src", "customer_src")
_SPARSE = ["Color", "SizeUnitMeasureCode", "WeightUnitMeasureCode", "Class", "Style"]
sql(
    "sparse_set",
    "SELECT ProductID, concat_ws(';', "
    + ", ".join(f"'{c}=' || {c}" for c in _SPARSE)
    + ") AS ColumnSet FROM product_src",
    "product_src",
)
sql(
    "masked_customers",
    r"""SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(
        c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_name,
    c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer""",
)
sql(
    "xml_fields",
    """SELECT c_custkey, c_name AS name, c_nationkey AS nation,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer""",
)
sql(
    "xml_values",
    """SELECT c_custkey, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer""",
)

# --- sinks ---------------------------------------------------------------------------------

sql(
    "sink_roundtrip_parquet",
    """SELECT CAST(year(OrderDate) AS INTEGER) AS Year, SalesOrderID, SalesOrderDetailID, LineTotal
    FROM fact_w""",
    "fact_w",
)
sql(
    "sink_roundtrip_table",
    f"""SELECT ProductSubcategoryName AS ProductSubcategory, {TOTAL_N} AS TotalRevenue
    FROM fact_n JOIN product_all USING (ProductKey) GROUP BY 1""",
    "fact_n",
)
sql(
    "loaded_star_rows",
    union(
        f"SELECT '{name}' AS TableName, count(*) AS \"Rows\" FROM {table}"
        for name, table, _ in [*NARROW_TABLES, ("FactCustomSales", "fact_n", "")]
    ),
    "fact_n",
)

# --- whole runs ----------------------------------------------------------------------------


def marts(fact: str, amount: str, parts: list[tuple[str, str, str, str]]) -> str:
    return union(
        f"""SELECT '{name}' AS Report, CAST({value} AS VARCHAR) AS "Value",
        {SUM.format(m=amount)} AS TotalRevenue FROM {fact} JOIN {table} USING ({key}) GROUP BY 2"""
        for name, value, table, key in parts
    )


sql(
    "warehouse_run_wide",
    marts("fact_w", "LineTotal", [
        ("revenue_by_category", "ProductCategoryName", "product_all", "ProductKey"),
        ("revenue_by_city", "City", "geography_wide", "GeographyKey"),
        ("revenue_by_year", "CalendarYear", "date_wide", "DateKey"),
    ]),
    "fact_w",
)
sql(
    "warehouse_run_narrow",
    marts("fact_n", "SalesAmount", [
        ("revenue_by_category", "ProductCategoryName", "product_all", "ProductKey"),
        ("revenue_by_city", "City", "geography_all", "GeographyKey"),
        ("revenue_by_year", "Year", "date_narrow", "DateKey"),
    ]),
    "fact_n",
)
SQL["load_twice_same_rows_narrow"] = SQL["loaded_star_rows"]
cte(
    "product_wide",
    "SELECT * FROM product_all WHERE ProductID IS NOT NULL AND Name IS NOT NULL AND "
    "ProductNumber IS NOT NULL AND StandardCost IS NOT NULL AND ListPrice IS NOT NULL AND "
    "ModifiedDate IS NOT NULL",
    "product_all",
)
sql(
    "load_twice_same_rows_wide",
    union(
        f"SELECT '{name}' AS TableName, count(*) AS \"Rows\" FROM {table}"
        for name, table in [
            ("DimCustomer", "customer_wide"), ("DimProduct", "product_wide"),
            ("DimGeography", "geography_wide"), ("DimDate", "date_wide"),
            ("FactCustomSales", "fact_w"),
        ]
    ),
    "fact_w", "product_wide",
)
sql(
    "append_later_customers_wide",
    f"""SELECT AccountNumber, {TOTAL_W} AS TotalRevenue
    FROM fact_w JOIN customer_wide USING (CustomerKey) GROUP BY 1""",
    "fact_w",
)
sql(
    "append_later_customers_narrow",
    f"""SELECT LastName, {TOTAL_N} AS TotalRevenue
    FROM fact_n JOIN customer_narrow USING (CustomerKey) GROUP BY 1""",
    "fact_n",
)
sql(
    "fact_wide_rejects",
    """SELECT 'LineTotal beyond decimal(10,4)' AS Rule, count(*) AS "Lines"
    FROM sales_order_detail_src WHERE abs(LineTotal) * 100 >= 1000000 GROUP BY 1""",
    "sales_order_detail_src",
)
cte("fact_left", wide_fact(kind="LEFT JOIN"), *WIDE_NEEDS)
sql(
    "revenue_by_city_left",
    f"""SELECT City, {TOTAL_W} AS TotalRevenue
    FROM fact_left LEFT JOIN geography_wide USING (GeographyKey) GROUP BY 1""",
    "fact_left",
)

SQL["conform_temporal"] = """SELECT o_orderkey,
    CAST(o_orderdate AS DATE) + INTERVAL 10 HOUR + to_minutes(o_orderkey % 60)
        + INTERVAL 21587654 MICROSECONDS
        - CASE WHEN o_orderkey % 2 = 0 THEN INTERVAL 120 MINUTE ELSE INTERVAL (-330) MINUTE END
        AS OrderedAt,
    CAST(25200.25 + 60 * (o_orderkey % 60) AS DOUBLE) AS ShiftSeconds,
    CASE WHEN o_orderkey % 3 = 0 THEN true WHEN o_orderkey % 3 = 1 THEN false END AS Flag,
    CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DECIMAL(19,4)) AS Total FROM orders"""
