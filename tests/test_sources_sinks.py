"""Dumps, files, load order, catalog tables and the options given to databases."""

import os
from datetime import date, datetime
from decimal import Decimal as Dec
from unittest import mock

import pytest
import warehouse_job
from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T
from starloom.operators.marts import largest_first
from starloom.operators.shape import inspect
from starloom.plans.star import build_star, reports, run_warehouse, staged
from starloom.sinks import (
    JdbcSink,
    ParquetSink,
    append_new_rows,
    load_order,
    load_star,
    write_csv,
    write_jdbc,
    write_parquet,
)
from starloom.sources.dumps import DUMPS, MULTI_LINE, PADDED, read_dump, read_records, read_tsv
from starloom.sources.jdbc import connection, jdbc_source, read_jdbc
from starloom.sources.retail import retail_source
from starloom.staging import settle, shared_dir

FOLDER = "/root/testdata/sf0.001"


def test_tsv_types(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        '1\tA "quoted" \\name\t2011-01-02 03:04:05.123456789\t12.5000\t1\t\n'
        "2\t\t2011-01-02 00:00:00\t\t0\t2012-01-01\n",
        encoding="utf-8",
    )
    schema = T.StructType.fromDDL(
        "id int, name string, at timestamp, rate decimal(19,4), flag boolean, until date"
    )
    got = read_tsv(spark, str(path), schema)
    assert got.schema.simpleString() == schema.simpleString()
    assert [tuple(r) for r in got.orderBy("id").collect()] == [
        (1, 'A "quoted" \\name', datetime(2011, 1, 2, 3, 4, 5, 123456), Dec("12.5000"), True, None),
        (2, None, datetime(2011, 1, 2), None, False, date(2012, 1, 1)),
    ]


RECORD = "id int, item int, note string, rating int"


def write_records(path, count, lines_each):
    text = ["a head line without a record"]
    for i in range(count):
        note = "\n".join([f"note {i}"] + [f"more {i} {j} 7 8" for j in range(lines_each)])
        text.append(f"{i}\t{i * 2}\t{note}\t{i % 5}")
    path.write_text("\n".join(text) + "\n", encoding="utf-8")


@pytest.mark.parametrize("split_bytes", ["128m", "700"])
def test_records_over_lines_and_splits(spark, tmp_path, split_bytes):
    """With 700-byte splits records begin in one split and end in another, some spanning more
    than two."""
    for name, count, lines_each in (("a", 40, 5), ("b", 3, 200)):
        write_records(tmp_path / f"{name}.txt", count, lines_each)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = read_records(spark, f"{tmp_path}/*.txt", r"^\d+\t\d+\t", T.StructType.fromDDL(RECORD))
        rows = got.orderBy("id", F.length("note")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == 43
    by_size = {(r.id, r.note.count("\n")): r for r in rows}
    for count, lines_each in ((40, 5), (3, 200)):
        for i in range(count):
            row = by_size[i, lines_each]
            assert (row.item, row.rating) == (i * 2, i % 5)
            assert row.note.endswith(f"more {i} {lines_each - 1} 7 8")


SAMPLES = {
    "int": ["7", "-3", ""], "string": ["ab  ", "x y", ""], "date": ["2011-05-31", "1999-12-31", ""],
    "timestamp": ["2008-04-30 00:00:00.000000000", "2013-02-08 10:17:21.587000000", ""],
    "boolean": ["0", "1", ""],
}


@pytest.mark.parametrize("name", DUMPS)
def test_dumps_fit_their_schema(spark, tmp_path, name):
    """Three records of every type's values; the last has only empty fields behind its key."""
    schema = T.StructType.fromDDL(DUMPS[name])
    kinds = [f.dataType.simpleString() for f in schema.fields]
    rows = []
    for k in range(3):
        row = [SAMPLES.get(kind, ["12.5000", "-0.25", ""])[k] for kind in kinds]
        if kinds[0] == "int":
            row[0] = str(k + 1)
        if name in MULTI_LINE:
            row[1], row[6] = str(k), f"first line {k}\nsecond line"
        rows.append(row)
    text = "".join("\t".join(row) + "\n" for row in rows)
    (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    got = read_dump(spark, str(tmp_path), name).collect()
    assert len(got) == 3
    empty = sum(field == "" for row in rows for field in row)
    assert sum(value is None for row in got for value in row) == empty
    if name in MULTI_LINE:
        assert {r.comments for r in got} == {f"first line {k}\nsecond line" for k in range(3)}
    assert not any(str(r[0]).endswith(" ") for r in got if name in PADDED)


def test_reports_of_one_star_agree_with_each_other(spark, tmp_path):
    """Written as CSV and read back, the three reports have one total."""
    source = retail_source(spark, "/root/testdata/sf0.001")
    star = run_warehouse(source, ParquetSink(str(tmp_path / "star")), "wide", ids="bigint")
    sums, tables = set(), {}
    for name, df in reports(star, "wide").items():
        write_csv(df, str(tmp_path / name))
        back = spark.read.schema(df.schema).csv(str(tmp_path / name), header=True)
        sums.add(back.agg(F.sum("TotalRevenue")).first()[0])
        tables[name] = df, back
    assert len(sums) == 1
    for k in ("category", "city"):
        df, back = tables[f"revenue_by_{k}"]
        published = [r.TotalRevenue for r in df.collect()]
        ours = largest_first(back, "TotalRevenue").collect()
        assert published == [r.TotalRevenue for r in ours]


def test_load_order_follows_references():
    tables = ["DimDate", "FactCustomSales", "DimProduct"]
    assert load_order(tables, "overwrite") == ["FactCustomSales", "DimDate", "DimProduct"]
    assert load_order(tables, "append") == ["DimDate", "DimProduct", "FactCustomSales"]
    calls = []
    load_star({t: t for t in tables}, lambda *a: calls.append(a), "append")
    assert calls[-1] == ("FactCustomSales", "FactCustomSales", "append")


@pytest.mark.parametrize("model", ["wide", "narrow"])
def test_whole_run_to_files(spark, tmp_path, model):
    source = retail_source(spark, FOLDER)
    star = run_warehouse(
        source,
        ParquetSink(f"{tmp_path}/star"),
        model,
        lambda name, df: write_csv(df, f"{tmp_path}/reports/{name}"),
    )
    detail = source("SalesOrderDetail")
    assert 0 < star["FactCustomSales"].count() <= detail.count()
    for key in ("CustomerKey", "ProductKey", "GeographyKey", "DateKey"):
        dim = star["Dim" + key.removesuffix("Key")]
        assert star["FactCustomSales"].join(dim, key, "left_anti").count() == 0
    measure = "LineTotal" if model == "wide" else "SalesAmount"
    total = star["FactCustomSales"].agg(F.sum(measure)).first()[0]
    for name in reports(star, model):
        report = spark.read.csv(f"{tmp_path}/reports/{name}", header=True)
        assert report.agg(F.sum(F.col("TotalRevenue").cast("decimal(29,4)"))).first()[0] == total


def test_sink_that_cannot_be_read_back_gets_the_same_star(spark):
    kept = {}

    def sink(name, df, mode):
        kept[name] = df.count()

    star = run_warehouse(retail_source(spark, FOLDER), sink, "narrow")
    assert list(kept)[0] == "FactCustomSales"
    assert kept == {name: df.count() for name, df in star.items()}


def test_a_second_build_gives_the_same_rows(spark):
    builds = [build_star(retail_source(spark, FOLDER), "wide") for _ in range(2)]
    for name, df in builds[0].items():
        assert df.exceptAll(builds[1][name]).isEmpty()
        assert df.count() == builds[1][name].count()


def test_parquet_sorted_and_partitioned(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 2).alias("p"), (100 - F.col("id")).alias("v"))
    write_parquet(df.coalesce(1), f"{tmp_path}/t", partition_by=["p"], sort_by=["v"])
    assert sorted(p for p in os.listdir(f"{tmp_path}/t") if "=" in p) == ["p=0", "p=1"]
    values = [r.v for r in spark.read.parquet(f"{tmp_path}/t/p=0").collect()]
    assert values == sorted(values) and len(values) == 50


def test_staged_tables_lie_in_the_shared_folder(spark):
    df = settle(spark.range(5), "numbers")
    assert all(shared_dir(spark) in f for f in df.inputFiles()) and df.count() == 5


def test_preview(spark, capsys):
    assert inspect(spark.range(100), 5).count() == 5
    assert "id: long" in capsys.readouterr().out


# No database may be started here: these tests look at what Spark's reader and writer are asked.


def test_connection_comes_from_the_environment():
    environ = {"SOURCE_JDBC_URL": "jdbc:x", "SOURCE_JDBC_USER": "u", "SOURCE_JDBC_PASSWORD": "p"}
    assert connection("source", environ) == ("jdbc:x", {"user": "u", "password": "p"})
    with pytest.raises(KeyError):
        connection("target", environ)


def test_jdbc_read_options(spark):
    with mock.patch.object(DataFrameReader, "jdbc") as jdbc:
        read_jdbc(spark, "url", "T", {"user": "u"})
        jdbc.assert_called_once_with("url", "T", properties={"user": "u", "fetchsize": "10000"})
        jdbc.reset_mock()
        jdbc.return_value.first.return_value = (5, 900)
        read_jdbc(spark, "url", "T", {}, "id", partitions=4, fetch_rows=50)
        bounds, scan = jdbc.call_args_list
        assert bounds.args[1] == "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM T) ends"
        assert scan.kwargs == {
            "column": "id", "lowerBound": 5, "upperBound": 900, "numPartitions": 4,
            "properties": {"fetchsize": "50"},
        }
        jdbc.return_value.first.return_value = (None, None)
        read_jdbc(spark, "url", "Empty", {}, "id")
        assert jdbc.call_args.kwargs["upperBound"] > jdbc.call_args.kwargs["lowerBound"]


def test_jdbc_source_cuts_large_tables(spark, monkeypatch):
    monkeypatch.setenv("SOURCE_JDBC_URL", "url")
    with mock.patch.object(DataFrameReader, "jdbc") as jdbc:
        jdbc.return_value.first.return_value = (1, 9)
        source = jdbc_source(spark)
        source("SalesOrderDetail")
        assert jdbc.call_args.args[1] == "Sales.SalesOrderDetail"
        assert jdbc.call_args.kwargs["column"] == "SalesOrderID"
        source("CountryRegion")
        assert "column" not in jdbc.call_args.kwargs


def test_jdbc_write_options(spark):
    with mock.patch.object(DataFrameWriter, "jdbc") as jdbc:
        write_jdbc(spark.range(3), "url", "T", {"user": "u"}, connections=2)
        assert jdbc.call_args.kwargs["mode"] == "overwrite"
        options = jdbc.call_args.kwargs["properties"]
        assert options["truncate"] == "false" and options["numPartitions"] == "2"


def test_database_sink(spark):
    df = spark.createDataFrame([(1, "x")], "DateKey int, MonthName string")
    with mock.patch.object(DataFrameWriter, "jdbc") as jdbc:
        JdbcSink("url", {}, {})("DimDate", df, "overwrite")
        assert jdbc.call_args.args == ("url", 'public."DimDate"')
        options = jdbc.call_args.kwargs["properties"]
        assert options["createTableColumnTypes"] == "MonthName VARCHAR(10)"
        JdbcSink("url", {}, {}, keep_tables=True)("DimDate", df, "overwrite")
        options = jdbc.call_args.kwargs["properties"]
        assert options["truncate"] == options["cascadeTruncate"] == "true"
        assert "createTableColumnTypes" not in options
    with mock.patch("starloom.sinks.jdbc.append_new_rows") as append:
        JdbcSink("url", {}, {"DimDate": ["DateKey"]})("DimDate", df, "append")
        append.assert_called_once_with(df, "url", 'public."DimDate"', {}, ["DateKey"], 8)


def test_kept_tables_are_emptied_before_those_they_refer_to(spark):
    calls = []
    tables = {n: spark.range(3) for n in ("DimDate", "FactCustomSales")}
    load_star(tables, lambda n, df, mode: calls.append((n, df.count(), mode)), keep_tables=True)
    assert calls == [
        ("FactCustomSales", 0, "overwrite"),
        ("DimDate", 3, "overwrite"),
        ("FactCustomSales", 3, "append"),
    ]


def test_append_leaves_out_held_keys(spark):
    written = []

    def keep(df, *args, **options):
        written.append(df)

    held = spark.createDataFrame([(1,), (2,)], "k long")
    with (
        mock.patch.object(DataFrameReader, "jdbc", return_value=held),
        mock.patch("starloom.sinks.jdbc.read_jdbc", return_value=held),
        mock.patch("starloom.sinks.jdbc.write_jdbc", side_effect=keep),
    ):
        df = spark.range(1, 5).select(F.col("id").alias("k"), F.lit("v").alias("v"))
        append_new_rows(df, "url", "T", {}, ["k"])
    assert isinstance(written[0], DataFrame)
    assert sorted(tuple(r) for r in written[0].collect()) == [(3, "v"), (4, "v")]


def test_job_previews_and_builds(spark, tmp_path, capsys):
    args = ["preview", "--tables", FOLDER, "--rows", "1"]
    warehouse_job.run(spark, warehouse_job.arguments(args))
    assert "CarrierTrackingNumber: string" in capsys.readouterr().out
    out = str(tmp_path)
    args = ["build", "--tables", FOLDER, "--out", out, "--model", "narrow"]
    warehouse_job.run(spark, warehouse_job.arguments(args))
    assert spark.read.parquet(f"{out}/narrow/FactCustomSales").count() == 6000
    report = spark.read.csv(f"{out}/aggregations/revenue_by_year", header=True)
    assert report.columns == ["Year", "TotalRevenue"] and report.count() == 7
    with pytest.raises(SystemExit):
        warehouse_job.arguments(["build", "--tables", FOLDER])


def test_job_loads_a_database(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("TARGET_JDBC_URL", "url")
    args = ["load", "--tables", FOLDER, "--out", str(tmp_path), "--model", "narrow"]
    with mock.patch.object(DataFrameWriter, "jdbc") as jdbc:
        warehouse_job.run(spark, warehouse_job.arguments(args))
    tables = [call.args[1] for call in jdbc.call_args_list]
    assert tables[0] == 'public."FactCustomSales"' and len(tables) == 5


def test_staged_source_reads_each_table_once(spark):
    asked = []

    def source(name):
        asked.append(name)
        return spark.range(3)

    once = staged(source)
    assert once("A").count() == once("A").count() == once("B").count() == 3
    assert asked == ["A", "B"]
