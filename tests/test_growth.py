"""Loads that are repeated or continued, key ranges, dump rejects and the layout of the fact."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from starloom.operators import keys
from starloom.operators.keys import dense_key, stable_key
from starloom.operators.skew import hot_keys
from starloom.plans.rejects import reject_counts, rejected_lines
from starloom.plans.schemas import FACT
from starloom.plans.star import NATURAL_KEYS, run_warehouse
from starloom.sinks import ParquetSink
from starloom.sources.dumps import read_records, span_records, tsv_records
from starloom.sources.retail import retail_source

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("model", ["wide", "narrow"])
def test_keys_and_lines_stay_over_loads(spark, tmp_path, model):
    source = retail_source(spark, FOLDER)

    def first(name):
        df = source(name)
        if name == "Customer":
            return df.where("CustomerID % 2 = 0")
        # lines of equal ids that differ: the wide fact keeps the one it loaded first
        late = name == "Product" and model == "narrow"
        return df.where("ProductID % 3 > 0") if late else df

    sink = ParquetSink(str(tmp_path / model))
    once = run_warehouse(source, ParquetSink(str(tmp_path / "once")), model, ids="bigint")
    run_warehouse(first, sink, model, mode="append", ids="bigint")
    before = {n: {tuple(r) for r in sink.keys.read(spark, n).collect()} for n in NATURAL_KEYS}
    for _ in range(2):
        star = run_warehouse(source, sink, model, mode="append", ids="bigint")
        for name, rows in before.items():
            now = {tuple(r) for r in sink.keys.read(spark, name).collect()}
            assert rows <= now and len({k for k, _ in now}) == len({s for _, s in now}) == len(now)
        assert {n: df.count() for n, df in star.items()} == {n: df.count() for n, df in once.items()}
    amount = "LineTotal" if model == "wide" else "SalesAmount"
    total = lambda s: s[FACT].agg(F.sum(amount)).first()[0]
    assert total(star) == total(once)


def test_appending_without_a_key_map_is_refused(spark):
    with pytest.raises(ValueError, match="key map"):
        run_warehouse(retail_source(spark, FOLDER), lambda *a: None, "wide", mode="append")


def test_fact_in_folders_is_pruned(spark, tmp_path):
    sink = ParquetSink(str(tmp_path), partition_by=["Year", "Month"], files=2)
    star = run_warehouse(retail_source(spark, FOLDER), sink, "wide", ids="bigint")
    fact = star[FACT]
    some = fact.where("Year = 1995 AND Month = 3")
    plan = some._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan
    assert some.count() == fact.where("DateKey DIV 100 = 199503").count() > 0
    files = fact.select("Year", "Month", F.input_file_name().alias("file")).distinct()
    assert files.groupBy("Year", "Month").count().agg(F.max("count")).first()[0] <= 2


VALUES = [5.0, -1.5, None, math.nan, 7.0, 1e300, -math.inf, math.inf, 0.25, 3.0]


@pytest.mark.parametrize("per_range", [1, 2, 1_000])
def test_null_first_and_nan_last(spark, per_range):
    df = spark.createDataFrame([(v,) for v in VALUES], "v double")
    got = [r.v for r in dense_key(df, "v", "k", rows_per_range=per_range).orderBy("k").collect()]
    assert got[0] is None and math.isnan(got[-1]) and got[1:-1] == sorted(got[1:-1])


def test_more_ranges_than_cuts(spark, monkeypatch):
    monkeypatch.setattr(keys, "CUTS", 4)
    df = spark.range(5_000).select((F.col("id") * F.col("id")).alias("v"))
    out = dense_key(df, "v", "k", rows_per_range=100).collect()
    assert sorted(r.k for r in out) == list(range(1, 5_001))
    assert all(r.v == (r.k - 1) ** 2 for r in out)
    assert dense_key(df.limit(0), "v", "k").count() == 0


def test_stable_keys(spark):
    df = spark.createDataFrame([(k,) for k in [4, 9, 2, 7, None]], "n int")
    held = spark.createDataFrame([(9, 1), (4, 6)], "n int, k int")
    got = {r.n: r.k for r in stable_key(df, "n", "k", held).collect()}
    assert got == {9: 1, 4: 6, None: 7, 2: 8, 7: 9}


SCHEMA = T.StructType(
    [T.StructField(n, t()) for n, t in (("id", T.IntegerType), ("n", T.IntegerType), ("note", T.StringType))]
)


def write(tmp_path, text):
    (tmp_path / "d.csv").write_text(text)
    return str(tmp_path / "d.csv")


def test_lines_that_do_not_fit_are_rejects(spark, tmp_path):
    path = write(tmp_path, "1\t2\ta\nbad\t3\tz\n2\t\tb\textra\n3\t4\n4\t\t\n")
    rows, rejects = tsv_records(spark, path, SCHEMA)
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [(1, 2, "a"), (4, None, None)]
    assert {r.reason for r in rejects.collect()} == {"id is not int", "4 fields", "2 fields"}
    rows, rejects = tsv_records(spark, path, SCHEMA, free_tail=True)
    assert {r.note for r in rows.collect()} == {"a", "b\textra", None} and rejects.count() == 2


def test_last_field_of_a_record_keeps_tabs_and_lines(spark, tmp_path, monkeypatch):
    path = write(tmp_path, "loose\n1\t5\tfirst part\tsecond part after a tab\nmore\n2\t6\tx\ny\nz\n")
    start = r"^\d+\t\d+\t"
    rows = read_records(spark, path, start, SCHEMA, free_tail=True).orderBy("id").collect()
    assert [r.note for r in rows] == ["first part\tsecond part after a tab\nmore", "x\ny\nz"]
    rows, rejects = span_records(spark, path, start, SCHEMA)
    assert rows.count() == 1
    assert {r.reason for r in rejects.collect()} == {"before the first record", "4 fields"}
    monkeypatch.setattr("starloom.sources.dumps.RECORD_LINES", 2)
    rows, rejects = span_records(spark, path, start, SCHEMA, free_tail=True)
    assert [r.id for r in rows.collect()] == [1] and rejects.count() == 4


def test_rows_alone_leave_no_long_record_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("starloom.sources.dumps.RECORD_LINES", 2)
    lines = [str(k) for k in range(5000)]
    path = write(tmp_path, "1\t5\tx\tfirst\n" + "\n".join(lines) + "\n\n2\t6\tx\ny\nz\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        rows = read_records(spark, path, r"^\d+\t\d+\t", SCHEMA, free_tail=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.id: r.note for r in rows} == {1: "\n".join(["x\tfirst", *lines, ""]), 2: "x\ny\nz"}


def test_rejected_measures(spark):
    lines = spark.createDataFrame(
        [(1, 1, 2, 3.0, 0.0, 12345678.5), (1, 2, None, 3.0, 0.0, 5.0), (1, 3, 1, 1.0, None, 1.0)],
        "SalesOrderID int, SalesOrderDetailID int, OrderQty int, UnitPrice double, "
        "UnitPriceDiscount double, LineTotal double",
    )
    got = {(r.SalesOrderDetailID, r.Rule) for r in rejected_lines(lines, "wide").collect()}
    assert got == {(1, "LineTotal beyond decimal(10,4)"), (2, "missing OrderQty")}
    assert {r.Rule: r.Lines for r in reject_counts(lines, "narrow").collect()} == {"missing OrderQuantity": 1}


def test_hot_is_measured_by_partitions(spark, monkeypatch):
    monkeypatch.setattr("starloom.operators.skew.HOT_ROWS", 10)
    df = spark.range(8_000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).cast("int").alias("k"), "id"
    )
    assert {k: set(v) for k, v in hot_keys(df, ["k", "id"]).items()} == {"k": {1}, "id": set()}


def test_several_changes_of_a_key(spark):
    from starloom.operators.changes import apply_changes

    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame(
        [(1, "x", "U", 1), (1, "y", "U", 2), (3, "z", "I", 1), (2, None, "D", 5)],
        "k int, v string, op string, at int",
    )
    got = apply_changes(target, changes, ["k"], order=["at"]).collect()
    assert sorted(map(tuple, got)) == [(1, "y"), (3, "z")]
    with pytest.raises(Exception, match="several changes"):
        apply_changes(target, changes, ["k"]).collect()
