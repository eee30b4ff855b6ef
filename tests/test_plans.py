"""Shapes of physical plans that decide how queries behave on large tables."""

import re

import pytest
import retail_queries as rq
from starloom.operators.shape import dedupe
from starloom.plans.facts import fact_wide
from starloom.sources.retail import retail_source

FOLDER = "/root/testdata/sf0.001"
# one row results, previews and tables that were counted to fit one range
ONE_TASK = {
    "total_sales", "growth_global", "preview_sales_order_header", "top_cities",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(rq.QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(rq.QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in plan
    if "SinglePartition" in plan:
        # a global aggregate's final step or a numbering that was checked to be small
        before = re.findall(r"SinglePartition.*\n.*?\+- (?:\*\(\d+\) )?(\w+)", plan)
        small = {"HashAggregate", "SortAggregate", "Project", "FileScan", "Union"}
        assert name in ONE_TASK or set(before) <= small, before


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)


def test_keeping_one_line_needs_no_shuffle_of_its_own(spark, no_broadcast):
    found = exchanges(plan_of(rq.QUERIES["fact_wide"](spark, FOLDER)))
    assert not [e for e in found if "SalesOrderDetailID" in e]
    # lines move for product, address and order; orders for day, customer and order;
    # each of the four dimensions once
    assert len(found) == 10


def test_small_dimensions_leave_one_shuffle_per_side(spark):
    found = exchanges(plan_of(rq.QUERIES["fact_wide"](spark, FOLDER)))
    assert [re.sub(r"#\d+L?", "", e) for e in found] == ["SalesOrderID"] * len(found)
    assert len(found) <= 2


def test_hot_orders_are_thinned_before_the_shuffle(spark, no_broadcast):
    source = retail_source(spark, FOLDER)
    dims = rq.dimension_tables(spark, FOLDER, "wide")
    fact = fact_wide(
        source("SalesOrderHeader"), source("SalesOrderDetail"), dims, ids="bigint", hot_rows=1
    )
    plan = plan_of(fact)
    assert "row_number(), 1, Partial" in plan and "_part#" in plan


def test_dedupe_limits_groups_inside_each_task(spark):
    detail = retail_source(spark, FOLDER)("SalesOrderDetail")
    plan = plan_of(dedupe(detail, ["SalesOrderID", "SalesOrderDetailID"]))
    assert "row_number(), 1, Partial" in plan


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(rq.QUERIES["fact_narrow"](spark, FOLDER))
    lines = next(l for l in plan.splitlines() if "lineitem.parquet" in l)
    assert "IsNotNull(l_orderkey)" in lines and "IsNotNull(l_partkey)" in lines
    assert "l_tax" not in lines and "l_shipdate" not in lines
    report = plan_of(rq.QUERIES["revenue_by_year"](spark, FOLDER))
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", report)
    assert "struct<DateKey:int,LineTotal:decimal(10,4)>" in scans


def test_revenue_is_summed_before_the_join(spark):
    plan = plan_of(rq.QUERIES["sales_by_category"](spark, FOLDER))
    join = plan.index("Join")
    assert plan.index("partial_sum", join) > join  # an aggregate below the join


def test_a_table_without_hot_keys_is_joined_plainly(spark):
    plan = plan_of(rq.QUERIES["fact_narrow"](spark, FOLDER))
    assert "_part#" not in plan
