"""Order lines whose measures do not fit the fact's types, by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.plans.schemas import FACT, REQUIRED, table_schema

# The source column of each measure of the narrow fact.
NARROW_MEASURES = {"OrderQuantity": "OrderQty", "SalesAmount": "LineTotal", "UnitPrice": "UnitPrice"}
WIDE_MEASURES = {c: c for c in ("OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal")}


def rejected_lines(detail: DataFrame, model: str, ids: str = "int") -> DataFrame:
    """One row per line and measure at fault: SalesOrderID, SalesOrderDetailID, Rule, Value.

    ``missing X``: a required measure is null in the source. ``X beyond TYPE``: the value does
    not fit, so the fact holds null there or, if it is required, drops the line."""
    schema = table_schema(model, FACT, ids)
    measures = WIDE_MEASURES if model == "wide" else NARROW_MEASURES
    required = set(REQUIRED[FACT]) if model == "wide" else set(measures)
    rules = []
    for name, source in measures.items():
        kind = schema[name].dataType
        lost = F.col(source).isNotNull() & F.col(source).try_cast(kind).isNull()
        rule = F.when(lost, F.lit(f"{name} beyond {kind.simpleString()}"))
        if name in required:
            rule = rule.when(F.col(source).isNull(), F.lit(f"missing {name}"))
        rules.append(F.struct(rule.alias("Rule"), F.col(source).cast("string").alias("Value")))
    return (
        detail.select("SalesOrderID", "SalesOrderDetailID", F.explode(F.array(*rules)).alias("at"))
        .where("at.Rule IS NOT NULL")
        .select("SalesOrderID", "SalesOrderDetailID", "at.Rule", "at.Value")
    )


def reject_counts(detail: DataFrame, model: str, ids: str = "int") -> DataFrame:
    """(Rule, Lines): how many lines each rule rejects."""
    return rejected_lines(detail, model, ids).groupBy("Rule").agg(F.count("*").alias("Lines"))
