"""Fact builders.

Order of the joins: customer, day and (if the order carries it) address are resolved on the
order headers, product on the lines; then headers and lines meet once. The lines, by far the
largest table, are shuffled for that one join, plus for products or addresses only where the keys
that they use are too many to broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import date_key
from starloom.operators.shape import conform, dedupe, require_not_null
from starloom.operators.skew import hot_keys, spread_join
from starloom.plans.schemas import FACT, REQUIRED, table_schema
from starloom.staging import settle

# The order columns that hold each kind of address.
ADDRESS_COLUMNS = {"ship": "ShipToAddressID", "bill": "BillToAddressID"}
LINE_KEYS = ["SalesOrderID", "SalesOrderDetailID"]
#: Rows of two ids that are sent to every task at most, some 8 MB.
SENT_KEYS = 500_000


def _near(keys: DataFrame, on: str, ids: DataFrame) -> DataFrame:
    """``keys`` for a join of column ``on`` with rows whose ids are among ``ids``: broadcast if they
    are few, or if those that occur are; else Spark's own threshold decides."""
    if keys.count() <= SENT_KEYS:
        return F.broadcast(keys)
    if ids.select(F.approx_count_distinct(on)).first()[0] <= SENT_KEYS:
        keys = settle(keys.join(ids.select(on).distinct(), on, "left_semi"), "used_keys")
        if keys.count() <= SENT_KEYS:
            return F.broadcast(keys)
    return keys


def _surrogate(
    df: DataFrame,
    ids: DataFrame,
    dim: DataFrame,
    natural: str,
    key: str,
    on: str,
    hot: Mapping[str, dict],
    hot_rows: int | None,
    how: str = "inner",
) -> DataFrame:
    """Replace the source id ``on`` by the dimension's surrogate key. ``ids`` is the source table that
    has these ids, or more."""
    keys = dim.select(F.col(natural).alias(on), key)
    if not hot[on]:
        keys = _near(keys, on, ids)
    return spread_join(df, keys, on, how, hot[on], hot_rows).drop(on)


def _with_keys(
    header: DataFrame,
    detail: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    dims: Mapping[str, DataFrame],
    address: str,
    geo_join: str,
    hot_rows: int | None,
) -> tuple[DataFrame, DataFrame, dict]:
    """Orders with CustomerKey, lines with ProductKey, GeographyKey on whichever of them holds
    the address, and the orders that are too large for one task. Hot ids are looked for in the
    source tables, before any join."""
    on_orders = address in orders.columns
    hot_orders = hot_keys(header, ["CustomerID", *[address] * on_orders], hot_rows)
    hot_lines = hot_keys(
        detail, ["SalesOrderID", "ProductID", *[address] * (not on_orders)], hot_rows
    )
    orders = _surrogate(
        orders, header, dims["DimCustomer"], "CustomerID", "CustomerKey", "CustomerID", hot_orders, hot_rows
    )
    lines = _surrogate(
        lines, detail, dims["DimProduct"], "ProductID", "ProductKey", "ProductID", hot_lines, hot_rows
    )
    place = (dims["DimGeography"], "AddressID", "GeographyKey", address)
    if on_orders:
        orders = _surrogate(orders, header, *place, hot_orders, hot_rows, geo_join)
    else:
        lines = _surrogate(lines, detail, *place, hot_lines, hot_rows, geo_join)
    return orders, lines, hot_lines["SalesOrderID"]


def fact_wide(
    header: DataFrame,
    detail: DataFrame,
    dims: Mapping[str, DataFrame],
    geo_role: str = "ship",
    geo_join: str = "inner",
    clean: bool = True,
    ids: str = "int",
    hot_rows: int | None = None,
    whole: DataFrame | None = None,
) -> DataFrame:
    """One row per order line with keys, measures and order attributes.

    ``geo_join="left"`` keeps lines whose address is not in the dimension. Among lines with the
    same order and line id one is kept, chosen by the lines' own values. ``header`` must be
    unique on SalesOrderID. Measures that do not fit their type become null, and ``clean``
    drops those rows. ``whole`` is the source table if ``detail`` is what a join has left of it: hot
    and used ids are looked for there, so that the join is not run for them."""
    schema = table_schema("wide", FACT, ids)
    address = ADDRESS_COLUMNS[geo_role]
    line_keys = LINE_KEYS
    measures = ["OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal"]

    orders = header.select(
        "SalesOrderID",
        "CustomerID",
        *[c for c in [address] if c in header.columns],
        date_key("OrderDate").alias("DateKey"),
        *[F.col(c).cast("date").alias(c) for c in ["OrderDate", "DueDate", "ShipDate"]],
        "OnlineOrderFlag",
        "SalesOrderNumber",
        F.col("ModifiedDate").cast("date").alias("ModifiedDate"),
    ).join(dims["DimDate"].select("DateKey"), "DateKey")
    lines = detail.select(
        *line_keys,
        "ProductID",
        *[c for c in [address] if c in detail.columns and c not in header.columns],
        *[F.col(c).try_cast(schema[c].dataType).alias(c) for c in measures],
        "CarrierTrackingNumber",
    )
    orders, lines, hot = _with_keys(
        header, detail if whole is None else whole, orders, lines, dims, address, geo_join, hot_rows
    )

    # Lines with equal ids meet in the partition that the join on the order id needs, so keeping
    # one of them costs no shuffle; it is done before the join, which takes the order of its sort.
    # Orders are made unique there, too: one of equal ids never gave a line two rows. Orders too large for a task are a branch of their own:
    # their lines are thinned out by order and line id first, and the join is spread.
    # Of equal ids a line whose required values all fit comes before one that would be dropped.
    needed = [c for c in measures if c in REQUIRED[FACT]]
    lacking = reduce(or_, [F.col(c).isNull() for c in needed])
    lines = lines.withColumn("_lacks", lacking)
    order = ["_lacks", *[c for c in lines.columns if c not in [*line_keys, "_lacks"]]]
    hot = {k: n for k, n in hot.items() if k is not None}
    large = F.col("SalesOrderID").isin(list(hot)) if hot else F.lit(False)
    usual = lines.where(F.col("SalesOrderID").isNotNull() & ~large)
    known = orders.where(F.col("SalesOrderID").isNotNull()).repartition("SalesOrderID")
    sales = dedupe(usual.repartition("SalesOrderID"), line_keys, order)
    sales = sales.join(dedupe(known, ["SalesOrderID"]), "SalesOrderID")
    if hot:
        thinned = dedupe(lines.where(large), line_keys, order)
        few = orders.where(large)
        spread = spread_join(thinned, few, "SalesOrderID", "inner", hot, hot_rows)
        sales = sales.unionByName(spread)

    out = conform(sales, schema)
    if not clean:
        return out
    required = [c for c in REQUIRED[FACT] if c != "GeographyKey" or geo_join == "inner"]
    return require_not_null(out, required)


def fact_narrow(
    header: DataFrame,
    detail: DataFrame,
    dims: Mapping[str, DataFrame],
    geo_role: str = "bill",
    geo_join: str = "inner",
    ids: str = "int",
    hot_rows: int | None = None,
    extra: Sequence[str] = (),
    whole: DataFrame | None = None,
) -> DataFrame:
    """One row per order line: four keys, quantity, amount and price. ``dims`` are the narrow
    dimensions with their natural keys. Lines are not de-duplicated in this model.

    ``extra`` names columns of ``detail`` to add, such as its ids, which the published columns
    leave out. Measures
    that do not fit their type are null; ``rejects.rejected_lines`` counts them. They travel in their
    source's type, which is shorter. ``whole`` as in ``fact_wide``."""
    schema = table_schema("narrow", FACT, ids)
    address = ADDRESS_COLUMNS[geo_role]

    def measure(source: str, name: str) -> Column:
        return F.col(source).alias(name)

    orders = header.select(
        "SalesOrderID",
        "CustomerID",
        *[c for c in [address] if c in header.columns],
        F.to_date("OrderDate").alias("FullDate"),
    )
    orders = orders.join(dims["DimDate"].select("FullDate", "DateKey"), "FullDate").drop("FullDate")
    lines = detail.select(
        "SalesOrderID",
        *[c for c in extra if c != "SalesOrderID"],
        "ProductID",
        *[c for c in [address] if c in detail.columns and c not in header.columns],
        measure("OrderQty", "OrderQuantity"),
        measure("LineTotal", "SalesAmount"),
        measure("UnitPrice", "UnitPrice"),
    )
    orders, lines, hot = _with_keys(
        header, detail if whole is None else whole, orders, lines, dims, address, geo_join, hot_rows
    )
    sales = spread_join(lines, orders, "SalesOrderID", "inner", hot, hot_rows)
    more = [T.StructField(c, detail.schema[c].dataType) for c in extra]
    schema = T.StructType([*schema.fields, *more])
    return conform(sales, schema, tolerant=["OrderQuantity", "SalesAmount", "UnitPrice"])
