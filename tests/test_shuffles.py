"""What the loads of a star shuffle, sort and read again."""

import pytest
from pyspark.sql import functions as F
from starloom.plans import facts, star
from starloom.plans.dims import dim_date_wide
from starloom.plans.star import run_warehouse
from starloom.sinks import AtomicStore, ParquetSink
from starloom.sinks.keymap import KeyMap

HEADER = """SalesOrderID bigint, CustomerID bigint, OrderDate timestamp, DueDate date, ShipDate date,
    OnlineOrderFlag int, SalesOrderNumber string, ModifiedDate date, BillToAddressID bigint"""
DETAIL = """SalesOrderID bigint, SalesOrderDetailID bigint, ProductID bigint, ShipToAddressID bigint, OrderQty int,
    UnitPrice decimal(12,2), UnitPriceDiscount decimal(4,2), LineTotal decimal(18,4),
    CarrierTrackingNumber string, ModifiedDate date"""


@pytest.fixture
def sales(spark):
    """40 orders of 3 lines, each first line there twice, products 0 to 19, addresses 0 and 1."""
    key = F.col("id")
    orders = spark.range(40).select(
        key.alias("SalesOrderID"), (key % 5).alias("CustomerID"), F.to_timestamp(F.lit("2012-05-01")).alias("OrderDate"),
        *[F.lit("2012-05-08").cast("date").alias(c) for c in ("DueDate", "ShipDate", "ModifiedDate")],
        F.lit(1).alias("OnlineOrderFlag"), F.lit("SO").alias("SalesOrderNumber"), key.alias("BillToAddressID"),
    )
    lines = spark.range(160).select(
        F.floor(key / 4).alias("SalesOrderID"), F.greatest(key % 4, F.lit(1)).alias("SalesOrderDetailID"),
        (key % 20).alias("ProductID"), (key % 2).alias("ShipToAddressID"), F.lit(1).alias("OrderQty"),
        *[key.cast("decimal(12,2)").alias(c) for c in ("UnitPrice", "LineTotal")], F.lit(0).alias("UnitPriceDiscount"),
        F.lit("T").alias("CarrierTrackingNumber"), F.lit("2012-05-08").cast("date").alias("ModifiedDate"),
    )
    header = spark.createDataFrame(orders.collect(), orders.schema)
    return header.select(*[c.split()[0] for c in HEADER.split(",")]), lines.select(*[c.split()[0] for c in DETAIL.replace("(12,2)", "").replace("(4,2)", "").replace("(18,4)", "").split(",")])


@pytest.fixture
def dims(spark, sales):
    def dim(natural, key, n):
        return spark.range(n).select(F.col("id").alias(natural), (F.col("id") + 1).alias(key))

    return {
        "DimCustomer": dim("CustomerID", "CustomerKey", 5), "DimProduct": dim("ProductID", "ProductKey", 20),
        "DimGeography": dim("AddressID", "GeographyKey", 100), "DimDate": dim_date_wide(*sales),
    }


@pytest.mark.parametrize("sent", [0, 3, 500_000])
def test_lines_are_shuffled_for_large_lookups_only(spark, sales, dims, monkeypatch, sent):
    expected = {tuple(r) for r in facts.fact_wide(*sales, dims, ids="bigint").collect()}
    assert len(expected) == 120
    monkeypatch.setattr(facts, "SENT_KEYS", sent)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = facts.fact_wide(*sales, dims, ids="bigint")
        assert {tuple(r) for r in fact.collect()} == expected
        plan = fact._jdf.queryExecution().sparkPlan().toString()
        # 3: the two addresses that occur among the hundred; 20 products and 5 customers are more
        assert plan.count("SortMergeJoin") == {0: 5, 3: 4, 500_000: 2}[sent]  # 2: days, orders
        assert plan.count("BroadcastHashJoin") == {0: 0, 3: 1, 500_000: 3}[sent]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("atomic", [False, True])
def test_a_second_load_looks_for_hot_ids_in_the_source_and_writes_its_lines_once(spark, tmp_path, monkeypatch, atomic):
    from starloom.sources.retail import retail_source

    source, plans, settled, known = retail_source(spark, "/root/testdata/sf0.001"), [], [], []
    real, settle, write = facts.hot_keys, star.settle, KeyMap.write
    monkeypatch.setattr(facts, "hot_keys", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, *a))
    monkeypatch.setattr(star, "settle", lambda df, name: settled.append(name) or settle(df, name))
    keep = lambda self, name, rows, mode: known.append((name, rows._jdf.queryExecution().optimizedPlan().toString())) or write(self, name, rows, mode)
    monkeypatch.setattr(KeyMap, "write", keep)
    store = AtomicStore(str(tmp_path / "store"))
    sink = None if atomic else ParquetSink(str(tmp_path / "star"))
    for _ in range(2):
        load = sink or store.begin(spark)
        out = run_warehouse(source, load, "wide", mode="append", ids="bigint")
    assert out[star.FACT].count() > 0
    lines = out[star.FACT].select(*facts.LINE_KEYS)
    assert lines.count() == lines.distinct().count()
    assert plans and not any("LeftAnti" in p for p in plans)
    assert not any("Aggregate" in p for name, p in known if name == star.FACT)
    assert not atomic or star.FACT not in settled
