"""Files that a filter on any one of several columns can pass over."""

import random
from datetime import date, timedelta

import pytest
from history_queries import SKIP_COLUMNS, SKIP_RANGES, skipping_table
from pyspark.sql import functions as F
from starloom.sinks import write_parquet
from starloom.sinks.interleaved import MANIFEST, files_for, read_interleaved, write_interleaved

FOLDER = "/root/testdata/sf0.01"


def test_each_column_opens_a_share_of_the_files(spark, tmp_path):
    """64 files are four slices of each of three columns. A narrow range lies in one slice, or in two
    that it straddles, and opens a quarter or a half of the files, where sorting inside tasks opens all;
    all three together open a few. Spark reads those files only."""
    path = skipping_table(spark, FOLDER)
    total = spark.read.parquet(f"{path}/{MANIFEST}").count()
    assert total >= 48
    opened = {c: len(files_for(spark, path, {c: r})) for c, r in SKIP_RANGES.items()}
    assert all(n <= 0.6 * total for n in opened.values()), (opened, total)
    assert sum(opened.values()) <= 0.45 * 3 * total
    together = files_for(spark, path, SKIP_RANGES)
    assert len(together) <= 0.15 * total
    read = read_interleaved(spark, path, SKIP_RANGES)
    assert {f.rsplit("/", 1)[1] for f in read.inputFiles()} == set(together)
    # as it was: every file spans every column
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").repartition(total)
    write_parquet(lines, f"{tmp_path}/sorted", sort_by=list(SKIP_COLUMNS))
    name = F.input_file_name()
    for c, (low, high) in SKIP_RANGES.items():
        spans = spark.read.parquet(f"{tmp_path}/sorted").groupBy(name).agg(F.min(c).alias("a"), F.max(c).alias("b"))
        assert spans.where((F.col("a") <= F.lit(high)) & (F.col("b") >= F.lit(low))).count() == spans.count()


@pytest.mark.parametrize("seed", [1, 2])
def test_any_ranges_give_the_rows_of_a_plain_filter(spark, tmp_path, seed):
    """Texts, days and numbers, nulls among them, one value in a third of all rows, a constant column."""
    rng = random.Random(seed)
    rows = [
        (
            7 if rng.random() < 0.33 else rng.randrange(500) if rng.random() < 0.95 else None,
            rng.choice(["a", "ab", "ñ", "z", None, f"t{rng.randrange(99)}"]),
            date(2020, 1, 1) + timedelta(days=rng.randrange(400)), 5, k,
        )
        for k in range(4000)
    ]
    df = spark.createDataFrame(rows, "n int, t string, d date, c int, `i` int")
    columns, path = ["n", "t", "d", "c"], f"{tmp_path}/x"
    write_interleaved(df, path, columns, 20)
    sizes = [r["rows"] for r in spark.read.parquet(f"{path}/{MANIFEST}").collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1200
    whole = {"n": (7, 7), "t": ("ab", "t5"), "d": (date(2020, 3, 1), None), "c": (None, 5)}
    for _ in range(8):
        ranges = {c: whole[c] for c in columns if rng.random() < 0.5}
        want = df
        for c, (low, high) in ranges.items():
            want = want.where(F.col(c) >= low if low is not None else F.lit(True))
            want = want.where(F.col(c) <= high if high is not None else F.lit(True))
        got = read_interleaved(spark, path, ranges)
        assert sorted(r.i for r in got.collect()) == sorted(r.i for r in want.collect())
    assert read_interleaved(spark, path, {"n": (9000, None)}).count() == 0


def test_empty_and_one_row(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n int, t string")
    for k, frame in enumerate((df, df.limit(0), df.select(F.lit(None).cast("int").alias("n"), "t"))):
        write_interleaved(frame, f"{tmp_path}/{k}", ["n", "t"], 4)
        assert read_interleaved(spark, f"{tmp_path}/{k}", {"t": ("a", "a")}).count() == frame.count()


def test_star_in_interleaved_files(spark, tmp_path):
    """The star that the sink writes is the same star; a customer's lines open a part of its files."""
    from starloom.plans.star import run_warehouse
    from starloom.sinks import ParquetSink
    from starloom.sources.retail import retail_source

    source = retail_source(spark, "/root/testdata/sf0.001")
    sink = ParquetSink(f"{tmp_path}/star", interleave=16)
    star = run_warehouse(source, sink, "narrow", ids="bigint")
    plain = run_warehouse(source, ParquetSink(f"{tmp_path}/plain"), "narrow", ids="bigint")
    for name, df in plain.items():
        assert star[name].count() == df.count() and star[name].exceptAll(df).isEmpty()
    path = f"{tmp_path}/star/FactCustomSales"
    key = plain["FactCustomSales"].agg(F.max("CustomerKey")).first()[0]
    assert len(files_for(spark, path, {"CustomerKey": (key, key)})) < 16
    lines = read_interleaved(spark, path, {"CustomerKey": (key, key)})
    assert lines.count() == plain["FactCustomSales"].where(F.col("CustomerKey") == key).count() > 0
    with pytest.raises(ValueError):
        sink("FactCustomSales", lines, "append")
    with pytest.raises(ValueError):
        ParquetSink("x", partition_by=["Year"], interleave=4)
