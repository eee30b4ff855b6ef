"""Queries over what holds for a time: prices, versions of rows, spans. Name -> query, name -> SQL.

Histories are derived from the retail tables: products have one to four list prices in turn, some
of them with a gap behind, and each twenty-fifth has three-day offers beside them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import retail_oracle
from starloom.operators.audit import audit_summary
from starloom.operators.discovery import candidate_keys, column_values, references
from starloom.operators.inference import inferred_types, merged_state, type_state
from starloom.operators.intervals import interval_join, merged_spans, span_gaps, span_overlaps
from starloom.operators.skew import hot_keys
from starloom.operators.versions import merge_versions, version_at
from starloom.plans.increments import KeptReports
from starloom.plans.schemas import DIMENSIONS, FACT
from starloom.plans.star import run_warehouse
from starloom.sinks import AtomicStore
from starloom.sinks.interleaved import read_interleaved, write_interleaved
from starloom.sources.retail import MONEY, retail_source, retail_table
from starloom.staging import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SPAN = ("StartDate", "EndDate")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _day(first: str, days: Column) -> Column:
    return F.date_add(F.lit(first).cast("date"), days.cast("int"))


def price_history(spark: SparkSession, folder: str) -> DataFrame:
    """ProductID, StartDate, EndDate (null: in force), ListPrice."""
    key, j = F.col("p_partkey"), F.col("j")
    part = retail_table(spark, folder, "part").select(key, F.col("p_retailprice").cast(MONEY).alias("price"))
    turns = part.withColumn("j", F.explode(F.sequence(F.lit(0), key % 4)))
    begin = j * 500 + key % 90
    end = F.when(j < key % 4, begin + 499).when(key % 3 == 0, begin + 400)
    regular = turns.select(
        key.alias("ProductID"), _day("1994-06-01", begin).alias("StartDate"),
        _day("1994-06-01", end).alias("EndDate"), (F.col("price") + 5 * j).cast(MONEY).alias("ListPrice"),
    )
    offers = part.where(key % 25 == 0).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(11))))
    return regular.unionByName(
        offers.select(
            key.alias("ProductID"), _day("1996-01-05", j * 30).alias("StartDate"),
            _day("1996-01-05", j * 30 + 2).alias("EndDate"), (F.col("price") - 1).cast(MONEY).alias("ListPrice"),
        )
    )


def cost_history(spark: SparkSession, folder: str) -> DataFrame:
    key, j = F.col("p_partkey"), F.col("j")
    part = retail_table(spark, folder, "part").select(key, F.col("p_retailprice").cast(MONEY).alias("price"))
    turns = part.withColumn("j", F.explode(F.sequence(F.lit(0), key % 3)))
    return turns.select(
        key.alias("ProductID"), _day("1995-03-01", j * 700).alias("CostFrom"),
        _day("1995-03-01", F.when(j < key % 3, j * 700 + 699)).alias("CostTo"),
        (F.col("price") - 300 + 2 * j).cast(MONEY).alias("StandardCost"),
    )


_PRICES = """prices AS (
    SELECT p_partkey AS "ProductID", DATE '1994-06-01' + (j * 500 + p_partkey % 90)::INTEGER AS "StartDate",
        CASE WHEN j < p_partkey % 4 THEN DATE '1994-06-01' + (j * 500 + p_partkey % 90 + 499)::INTEGER
            WHEN p_partkey % 3 = 0 THEN DATE '1994-06-01' + (j * 500 + p_partkey % 90 + 400)::INTEGER
            END AS "EndDate",
        (p_retailprice::DECIMAL(12,2) + 5 * j)::DECIMAL(12,2) AS "ListPrice"
    FROM (SELECT *, unnest(range(p_partkey % 4 + 1)) AS j FROM part)
    UNION ALL
    SELECT p_partkey, DATE '1996-01-05' + (j * 30)::INTEGER, DATE '1996-01-05' + (j * 30 + 2)::INTEGER,
        (p_retailprice::DECIMAL(12,2) - 1)::DECIMAL(12,2)
    FROM (SELECT *, unnest(range(12)) AS j FROM part WHERE p_partkey % 25 = 0))"""
_COSTS = """costs AS (
    SELECT p_partkey AS "ProductID", DATE '1995-03-01' + (j * 700)::INTEGER AS "CostFrom",
        CASE WHEN j < p_partkey % 3 THEN DATE '1995-03-01' + (j * 700 + 699)::INTEGER END AS "CostTo",
        (p_retailprice::DECIMAL(12,2) - 300 + 2 * j)::DECIMAL(12,2) AS "StandardCost"
    FROM (SELECT *, unnest(range(p_partkey % 3 + 1)) AS j FROM part))"""


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their product and the day of the order."""
    source = retail_source(spark, folder)
    header = source("SalesOrderHeader").select("SalesOrderID", F.to_date("OrderDate").alias("OrderDate"))
    detail = source("SalesOrderDetail").select("SalesOrderID", "SalesOrderDetailID", "ProductID")
    return detail.join(header, "SalesOrderID")


_LINES = """lines AS (
    SELECT l_orderkey AS "SalesOrderID", l_linenumber AS "SalesOrderDetailID", l_partkey AS "ProductID",
        o_orderdate::DATE AS "OrderDate"
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query
def price_in_force(spark: SparkSession, folder: str) -> DataFrame:
    """Every list price in force on the day of the order, by order line; lines without one stay."""
    prices = price_history(spark, folder)
    return interval_join(
        _lines(spark, folder), prices, ["ProductID"], ("OrderDate", "OrderDate"), SPAN, "left"
    )


SQL["price_in_force"] = f"""
WITH {_PRICES}, {_LINES}
SELECT lines.*, "StartDate", "EndDate", "ListPrice"
FROM lines LEFT JOIN prices ON prices."ProductID" = lines."ProductID"
    AND "OrderDate" >= "StartDate" AND ("EndDate" IS NULL OR "OrderDate" <= "EndDate")
"""


@query
def price_in_force_hot_products(spark: SparkSession, folder: str) -> DataFrame:
    """The same for lines with a price, built as if products of over twice the mean number of lines
    were hot and had their rows spread inside a bucket too."""
    lines = _lines(spark, folder)
    products = retail_table(spark, folder, "part").count()
    rows = max(2, 2 * lines.count() // max(products, 1))
    hot = hot_keys(retail_source(spark, folder)("SalesOrderDetail"), ["ProductID"], rows)["ProductID"]
    prices = price_history(spark, folder)
    return interval_join(
        lines, prices, ["ProductID"], ("OrderDate", "OrderDate"), SPAN, hot=hot, hot_rows=rows
    )


SQL["price_in_force_hot_products"] = SQL["price_in_force"].replace("LEFT JOIN", "JOIN")


@query
def margin_spans(spark: SparkSession, folder: str) -> DataFrame:
    """For each product the times with one list price and one cost, and the margin then."""
    both = interval_join(
        price_history(spark, folder), cost_history(spark, folder), ["ProductID"], SPAN, ("CostFrom", "CostTo")
    )
    return both.select(
        "ProductID", F.greatest("StartDate", "CostFrom").alias("FromDate"),
        F.least("EndDate", "CostTo").alias("ToDate"), (F.col("ListPrice") - F.col("StandardCost")).alias("Margin"),
    )


SQL["margin_spans"] = f"""
WITH {_PRICES}, {_COSTS}
SELECT "ProductID", greatest("StartDate", "CostFrom") AS "FromDate", least("EndDate", "CostTo") AS "ToDate",
    "ListPrice" - "StandardCost" AS "Margin"
FROM prices JOIN costs USING ("ProductID")
WHERE "StartDate" <= coalesce("CostTo", DATE '9999-12-31') AND "CostFrom" <= coalesce("EndDate", DATE '9999-12-31')
"""


@query
def price_spans_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The times in which a product has any price."""
    return merged_spans(price_history(spark, folder), ["ProductID"], SPAN)


def _running(source: str, key: str, start: str, end: str, far: str, step: str) -> str:
    """Spans with the latest end before them in their key."""
    return f"""ends AS (SELECT {key}, {start} AS s, coalesce({end}, {far}) AS e FROM {source}),
ran AS (
    SELECT *, max(e) OVER w AS b FROM ends
    WINDOW w AS (PARTITION BY {key} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (SELECT *, (b IS NULL OR s > b + {step})::BIGINT AS f FROM ran),
numbered AS (SELECT *, sum(f) OVER (PARTITION BY {key} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS n FROM flagged)"""


_PRICE_RUN = _running("prices", '"ProductID"', '"StartDate"', '"EndDate"', "DATE '9999-12-31'", "1")
SQL["price_spans_merged"] = f"""
WITH {_PRICES}, {_PRICE_RUN}
SELECT "ProductID", min(s) AS "StartDate", nullif(max(e), DATE '9999-12-31') AS "EndDate", count(*) AS "Rows"
FROM numbered GROUP BY "ProductID", n
"""


@query
def price_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    """Prices that start while another one of their product is in force: the offers."""
    return span_overlaps(price_history(spark, folder), ["ProductID"], SPAN)


SQL["price_overlaps"] = f"""
WITH {_PRICES}, {_PRICE_RUN}
SELECT "ProductID", s AS "StartDate", nullif(least(e, b), DATE '9999-12-31') AS "EndDate"
FROM ran WHERE s <= b
"""


def _visits(spark: SparkSession, folder: str) -> DataFrame:
    """Each event as a visit of its user that lasts up to an hour; null users are a user."""
    seconds = (F.col("event_id") % 7 * 600).cast("int")
    last = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    user = F.when(F.col("user_id") % 10 != 0, F.col("user_id"))
    return retail_table(spark, folder, "events").select(
        user.alias("UserID"), F.col("ts").alias("FromTime"), last.alias("ToTime")
    )


_VISITS = """visits AS (
    SELECT CASE WHEN user_id % 10 <> 0 THEN user_id END AS "UserID", ts AS "FromTime",
        ts + to_seconds(event_id % 7 * 600) AS "ToTime" FROM events)"""
_VISIT_RUN = _running("visits", '"UserID"', '"FromTime"', '"ToTime"', "TIMESTAMP '9999-12-31'", "INTERVAL 1 MICROSECOND")


@query
def user_visits_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The times in which a user was there at all, from overlapping visits."""
    return merged_spans(_visits(spark, folder), ["UserID"], ("FromTime", "ToTime"), "Visits")


SQL["user_visits_merged"] = f"""
WITH {_VISITS}, {_VISIT_RUN}
SELECT "UserID", min(s) AS "FromTime", max(e) AS "ToTime", count(*) AS "Visits" FROM numbered GROUP BY "UserID", n
"""


@query
def user_absences(spark: SparkSession, folder: str) -> DataFrame:
    """The times between a user's visits."""
    return span_gaps(_visits(spark, folder), ["UserID"], ("FromTime", "ToTime"))


SQL["user_absences"] = f"""
WITH {_VISITS}, {_VISIT_RUN}
SELECT "UserID", b + INTERVAL 1 MICROSECOND AS "FromTime", s - INTERVAL 1 MICROSECOND AS "ToTime"
FROM flagged WHERE f = 1 AND b IS NOT NULL
"""


SNAPSHOT_DAYS = [date(1996, 1, 1), date(1997, 6, 1), date(1999, 1, 1)]


def _customers_on(spark: SparkSession, folder: str, turn: int, wrong: bool = False) -> DataFrame:
    """Customers as they are on the turn's day: some come later, some go for a while, segments and
    nations change. ``wrong`` gives a version that the next load of the day corrects."""
    key, segment, nation = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey")
    there = [key % 10 != 9, key % 13 != 5, F.lit(True)][turn]
    if turn == 1:
        segment = F.when(key % 4 != 0, segment).otherwise("MOVED")
    if turn > 0:
        nation = F.when(key % 6 == 0, (nation + 1) % 25).otherwise(nation)
    if wrong:
        segment = F.when(key % 7 == 0, "WRONG").otherwise(segment)
    return retail_table(spark, folder, "customer").where(there).select(
        key.alias("CustomerID"), segment.alias("Segment"), nation.cast("int").alias("NationID")
    )


def _customer_versions(spark: SparkSession, folder: str, mistake: bool = True) -> DataFrame:
    """Three snapshots; the second is loaded twice, the third corrects a mistaken one of its day."""
    held = None
    for turn, wrong in ((0, False), (1, False), (1, False), (2, mistake), (2, False)):
        held = merge_versions(
            held, _customers_on(spark, folder, turn, wrong), ["CustomerID"], SNAPSHOT_DAYS[turn],
            "CustomerVersionKey", close_missing=True,
        )
    return held


@query
def customer_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Every version of every customer with the days on which it held."""
    return _customer_versions(spark, folder).select(
        "CustomerID", "Segment", "NationID", "ValidFrom", "ValidTo"
    )


@query
def customer_version_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of versions are unique, without gaps, and ascend with the day of their load."""
    versions = _customer_versions(spark, folder, mistake=False)
    return versions.groupBy("ValidFrom").agg(
        F.count("*").alias("Versions"), F.countDistinct("CustomerVersionKey").alias("Keys"),
        F.min("CustomerVersionKey").alias("LowKey"), F.max("CustomerVersionKey").alias("HighKey"),
    )


_VERSIONS = """days(turn, day) AS (VALUES (0, DATE '1996-01-01'), (1, DATE '1997-06-01'), (2, DATE '1999-01-01')),
states AS (
    SELECT c_custkey AS k, turn, day,
        CASE turn WHEN 0 THEN c_custkey % 10 <> 9 WHEN 1 THEN c_custkey % 13 <> 5 ELSE true END AS there,
        CASE WHEN turn = 1 AND c_custkey % 4 = 0 THEN 'MOVED' ELSE c_mktsegment END AS segment,
        CASE WHEN turn > 0 AND c_custkey % 6 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS nation
    FROM customer CROSS JOIN days),
compared AS (
    SELECT *, there AND coalesce(NOT lag(there) OVER w OR lag(segment) OVER w <> segment
        OR lag(nation) OVER w <> nation, true) AS opens
    FROM states WINDOW w AS (PARTITION BY k ORDER BY turn)),
runs AS (SELECT *, sum(opens::INTEGER) OVER (PARTITION BY k ORDER BY turn) AS run FROM compared),
versions AS (
    SELECT k AS "CustomerID", min(segment) AS "Segment", min(nation)::INTEGER AS "NationID",
        CASE WHEN min(turn) > 0 THEN min(day) END AS "ValidFrom",
        (SELECT day - 1 FROM days WHERE turn = max(runs.turn) + 1) AS "ValidTo", min(turn) AS turn
    FROM runs WHERE there GROUP BY k, run)"""
SQL["customer_versions"] = f"""
WITH {_VERSIONS} SELECT "CustomerID", "Segment", "NationID", "ValidFrom", "ValidTo" FROM versions
"""
SQL["customer_version_keys"] = f"""
WITH {_VERSIONS}, counted AS (SELECT "ValidFrom", turn, count(*) AS n FROM versions GROUP BY ALL),
summed AS (SELECT *, sum(n) OVER (ORDER BY turn) AS high FROM counted)
SELECT "ValidFrom", n AS "Versions", n AS "Keys", (high - n + 1)::BIGINT AS "LowKey", high::BIGINT AS "HighKey"
FROM summed
"""


@query
def sales_by_segment_then(spark: SparkSession, folder: str) -> DataFrame:
    """Order totals by the segment that the customer was in on the day of the order."""
    orders = retail_table(spark, folder, "orders").select(
        F.col("o_custkey").alias("CustomerID"), F.to_date("o_orderdate").alias("OrderDate"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("Total"),
    )
    versions = _customer_versions(spark, folder)
    then = version_at(orders, versions, ["CustomerID"], "OrderDate", ["Segment"])
    return then.groupBy("Segment").agg(
        F.count("*").alias("Orders"), F.sum("Total").cast("decimal(29,4)").alias("Total")
    )


SQL["sales_by_segment_then"] = f"""
WITH {_VERSIONS}
SELECT "Segment", count(*) AS "Orders", sum(o_totalprice::DECIMAL(15,2))::DECIMAL(29,4) AS "Total"
FROM orders LEFT JOIN versions ON o_custkey = "CustomerID"
    AND o_orderdate::DATE >= coalesce("ValidFrom", DATE '0001-01-01')
    AND o_orderdate::DATE <= coalesce("ValidTo", DATE '9999-12-31')
GROUP BY "Segment"
"""


def _atomic(model: str, spark: SparkSession, folder: str) -> DataFrame:
    """Customers of odd ids loaded, a load of all that dies between the fact and its key map, a load
    of all, and the same again: rows of each table as the store then has them."""
    source, store = retail_source(spark, folder), AtomicStore(new_path(spark, f"atomic_{model}"))

    def half(name: str) -> DataFrame:
        df = source(name)
        return df.where("CustomerID % 2 = 1") if name == "Customer" else df

    def load(tables) -> None:
        run_warehouse(tables, store.begin(spark), model, mode="append", ids="bigint")

    load(half)
    dying = store.begin(spark)
    for name in (FACT, "DimCustomer"):
        dying(name, store.read(spark, name), "append")
    load(source)
    load(source)
    star = {name: store.read(spark, name) for name in (*DIMENSIONS, FACT)}
    return audit_summary(star).withColumnsRenamed({"Rule": "TableName", "Findings": "Rows"})


for _model in ("wide", "narrow"):
    QUERIES[f"atomic_loads_{_model}"] = partial(_atomic, _model)
    SQL[f"atomic_loads_{_model}"] = retail_oracle.SQL[f"load_twice_same_rows_{_model}"]


def _kept(model: str, spark: SparkSession, folder: str) -> DataFrame:
    """Reports read from the sums of each load: customers of odd ids, all customers, the second load
    withdrawn and loaded anew, then the sums compacted."""
    source, store, kept = retail_source(spark, folder), AtomicStore(new_path(spark, f"kept_{model}")), KeptReports(model)

    def half(name: str) -> DataFrame:
        df = source(name)
        return df.where("CustomerID % 2 = 1") if name == "Customer" else df

    names = []
    for tables in (half, source, None, source):
        load = store.begin(spark)
        if tables is None:
            kept.withdraw(load, names[1])
            load.publish()
            continue
        run_warehouse(tables, load, model, mode="append", ids="bigint", kept=kept)
        names.append(load.name)
    load = store.begin(spark)
    kept.compact(load)
    load.publish()
    out = []
    for name, df in kept.reports(store, spark).items():
        value, total = df.columns
        out.append(df.select(F.lit(name).alias("Report"), F.col(value).cast("string").alias("Value"), total))
    return out[0].unionByName(out[1]).unionByName(out[2])


for _model in ("wide", "narrow"):
    QUERIES[f"kept_reports_{_model}"] = partial(_kept, _model)
    SQL[f"kept_reports_{_model}"] = retail_oracle.SQL[f"warehouse_run_{_model}"]


SKIP_COLUMNS = ("l_partkey", "l_suppkey", "l_shipdate")
SKIP_RANGES = {
    "l_partkey": (100, 140), "l_suppkey": (3, 5),
    "l_shipdate": (datetime(1997, 3, 1), datetime(1997, 4, 15)),
}


def skipping_table(spark: SparkSession, folder: str, files: int = 64) -> str:
    """All order lines in files of ranges of three columns at once; where they lie."""
    path = new_path(spark, "interleaved_lines")
    write_interleaved(retail_table(spark, folder, "lineitem"), path, SKIP_COLUMNS, files)
    return path


@query
def lines_by_each_column(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines in a range of one column, of each in turn, and of all three, each read from the
    files that may hold them."""
    path, out = skipping_table(spark, folder), []
    for name, ranges in [*((c, {c: r}) for c, r in SKIP_RANGES.items()), ("all", SKIP_RANGES), ("none", {})]:
        rows = read_interleaved(spark, path, ranges)
        total = F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(29,4)")
        out.append(rows.agg(F.lit(name).alias("ByColumn"), F.count("*").alias("Rows"), total.alias("Quantity")))
    return reduce(DataFrame.unionByName, out)


_SKIP_WHERE = {
    "l_partkey": "l_partkey BETWEEN 100 AND 140", "l_suppkey": "l_suppkey BETWEEN 3 AND 5",
    "l_shipdate": "l_shipdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-04-15'",
}
SQL["lines_by_each_column"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS "ByColumn", count(*) AS "Rows",
    sum(l_quantity::DECIMAL(18,2))::DECIMAL(29,4) AS "Quantity" FROM lineitem WHERE {where}"""
    for name, where in {**_SKIP_WHERE, "all": " AND ".join(_SKIP_WHERE.values()), "none": "true"}.items()
)


DISCOVERED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _discovered(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    tables = {name: retail_table(spark, folder, name) for name in DISCOVERED}
    return column_values(tables), tables


@query
def found_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Every column of the retail tables: its rows, nulls and values, and whether it is a key."""
    return candidate_keys(*_discovered(spark, folder))


@query
def found_references(spark: SparkSession, folder: str) -> DataFrame:
    """Columns that have nearly all their values in a key of another table, with the rows that break it."""
    return references(*_discovered(spark, folder), least_share=0.9)


# The columns of the tables by kind of value.
_COLUMNS = {
    "region": {"r_regionkey": "number", "r_name": "text"},
    "nation": {"n_nationkey": "number", "n_name": "text", "n_regionkey": "number"},
    "customer": {
        "c_custkey": "number", "c_name": "text", "c_nationkey": "number", "c_acctbal": "real", "c_mktsegment": "text",
    },
    "supplier": {"s_suppkey": "number", "s_name": "text", "s_nationkey": "number", "s_acctbal": "real"},
    "part": {
        "p_partkey": "number", "p_name": "text", "p_brand": "text", "p_type": "text", "p_size": "number",
        "p_retailprice": "real",
    },
    "orders": {
        "o_orderkey": "number", "o_custkey": "number", "o_orderstatus": "text", "o_totalprice": "real",
        "o_orderdate": "time", "o_orderpriority": "text",
    },
    "lineitem": {
        "l_orderkey": "number", "l_partkey": "number", "l_suppkey": "number", "l_linenumber": "number",
        "l_quantity": "real", "l_extendedprice": "real", "l_discount": "real", "l_tax": "real",
        "l_returnflag": "text", "l_linestatus": "text", "l_shipdate": "time",
    },
}
_COUNTED = "counted AS (" + " UNION ALL ".join(
    f"""SELECT '{t}' AS t, '{c}' AS c, '{k}' AS kind, {c}::VARCHAR AS v, count(*) AS n FROM {t}
    GROUP BY {c}""" for t, columns in _COLUMNS.items() for c, k in columns.items()
) + """), keys AS (
    SELECT t AS "TableName", c AS "ColumnName", sum(n)::BIGINT AS "Rows",
        coalesce(sum(n) FILTER (v IS NULL), 0)::BIGINT AS "Nulls", count(v) AS "Values",
        count(*) FILTER (v IS NOT NULL AND n > 1) AS "Repeated",
        count(*) FILTER (v IS NULL OR n > 1) = 0 AS "IsKey"
    FROM counted GROUP BY t, c)"""  # fmt: skip
SQL["found_keys"] = f"WITH {_COUNTED} SELECT * FROM keys"
SQL["found_references"] = f"""
WITH {_COUNTED},
shared AS (
    SELECT a.t AS child_t, a.c AS child_c, b.t AS parent_t, b.c AS parent_c, count(*) AS s, sum(a.n) AS r
    FROM counted a JOIN counted b ON a.kind = b.kind AND a.v = b.v AND a.t <> b.t GROUP BY ALL)
SELECT child_t || '.' || child_c AS "ChildColumn", parent_t || '.' || parent_c AS "ParentColumn", c."Values", s AS "Shared",
    (c."Rows" - c."Nulls" - r)::BIGINT AS "BrokenRows"
FROM shared JOIN keys c ON c."TableName" = child_t AND c."ColumnName" = child_c
JOIN keys p ON p."TableName" = parent_t AND p."ColumnName" = parent_c
WHERE p."IsKey" AND s >= 0.9 * c."Values"
"""


def _untyped(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as a dump without a schema has them: every column a text."""
    key, price = F.col("l_orderkey"), F.col("l_extendedprice").cast("decimal(12,2)")
    return retail_table(spark, folder, "lineitem").select(
        key.cast("string").alias("OrderID"), (key * 10_000_000_000).cast("string").alias("LongID"),
        (key % 2).cast("string").alias("Flag"), price.cast("string").alias("Price"),
        F.when(key % 7 != 0, (-price).cast("string")).otherwise(F.col("l_linenumber").cast("string")).alias("Mixed"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ShipDay"),
        F.when(key % 3 == 0, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("ShipTime"),
        F.when(key % 1000 != 0, key.cast("string")).otherwise("n/a").alias("Broken"),
        F.lpad(key.cast("string"), 9, "0").alias("Padded"), F.when(key % 5 == 0, F.lit("")).alias("Nothing"),
        F.when(key % 4 == 0, F.col("l_returnflag")).alias("Letter"),
    )


@query
def inferred_column_types(spark: SparkSession, folder: str) -> DataFrame:
    """The narrowest type of each column and how many values keep it from a narrower one, merged from
    the states of two halves of the lines."""
    lines = _untyped(spark, folder)
    halves = [type_state(lines.where(f"Flag = '{k}'")) for k in (0, 1)]
    return inferred_types(merged_state(halves[0].unionByName(halves[1])))


_UNTYPED = {
    "OrderID": "l_orderkey::VARCHAR", "LongID": "(l_orderkey * 10000000000)::VARCHAR",
    "Flag": "(l_orderkey % 2)::VARCHAR", "Price": "l_extendedprice::DECIMAL(12,2)::VARCHAR",
    "Mixed": "CASE WHEN l_orderkey % 7 <> 0 THEN (-l_extendedprice::DECIMAL(12,2))::VARCHAR ELSE l_linenumber::VARCHAR END",
    "ShipDay": "strftime(l_shipdate, '%Y-%m-%d')",
    "ShipTime": """CASE WHEN l_orderkey % 3 = 0 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
        ELSE strftime(l_shipdate, '%Y-%m-%d') END""",
    "Broken": "CASE WHEN l_orderkey % 1000 <> 0 THEN l_orderkey::VARCHAR ELSE 'n/a' END",
    "Padded": "lpad(l_orderkey::VARCHAR, 9, '0')", "Nothing": "NULL",
    "Letter": "CASE WHEN l_orderkey % 4 = 0 THEN l_returnflag END",
}
SQL["inferred_column_types"] = """
WITH cells AS (""" + " UNION ALL ".join(
    f"SELECT '{name}' AS c, {value} AS v FROM lineitem" for name, value in _UNTYPED.items()
) + r"""),
read AS (
    SELECT *, v IN ('0', '1') AS is_bit,
        regexp_matches(v, '^-?(0|[1-9][0-9]*)$') AND try_cast(v AS INTEGER) IS NOT NULL AS is_int,
        regexp_matches(v, '^-?(0|[1-9][0-9]*)$') AND try_cast(v AS BIGINT) IS NOT NULL AS is_bigint,
        regexp_matches(v, '^-?(0|[1-9][0-9]*)(\.[0-9]+)?$') AS is_decimal,
        regexp_matches(v, '^\d{4}-\d\d-\d\d$') AS is_date,
        regexp_matches(v, '^\d{4}-\d\d-\d\d( \d\d:\d\d:\d\d)?$') AS is_time FROM cells),
counted AS (
    SELECT c, count(*) AS n, count(v) AS known, coalesce(max(length(v)), 0) AS longest,
        max(length(regexp_extract(v, '^-?([0-9]+)', 1))) FILTER (is_decimal) AS digits,
        max(length(regexp_extract(v, '\.([0-9]+)$', 1))) FILTER (is_decimal) AS scale,
        [count(*) FILTER (NOT is_bit), count(*) FILTER (NOT is_int), count(*) FILTER (NOT is_bigint),
         count(*) FILTER (NOT is_decimal), count(*) FILTER (NOT is_date), count(*) FILTER (NOT is_time)] AS misses
    FROM read GROUP BY c)
SELECT c AS "ColumnName",
    CASE WHEN known = 0 THEN 'null' WHEN list_contains(misses, 0) THEN ['bit', 'int', 'bigint',
        'decimal(' || (digits + scale) || ',' || scale || ')', 'date', 'timestamp'][list_position(misses, 0)]
        ELSE 'varchar(' || longest || ')' END AS "Type",
    n AS "Rows", n - known AS "Empty", longest AS "Longest",
    coalesce(list_min(list_filter(misses, lambda m: m > 0 AND m < known)), 0) AS "Breaks"
FROM counted
"""
