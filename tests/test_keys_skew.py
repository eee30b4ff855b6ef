"""Dense keys against one global window, and hot-key joins against plain joins."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from starloom.operators.keys import dense_key
from starloom.operators.lookup import lookup
from starloom.operators.skew import hot_keys, spread_join

KEYS = {
    "sparse integers": "id * id * 7 - 1000",
    "clustered integers": "if(id < 900, id, id + 1099511627776)",
    "beyond 2^53": "1152921504606846976 + id",
    "decimals": "cast(id as decimal(12,2)) / 4",
    "text": "concat('common-prefix-', hex((id * 7919) % 1009))",
    "days": "date_add(date'1990-01-01', cast(id as int))",
}


@pytest.mark.parametrize("kind", KEYS)
def test_dense_key_equals_global_window(spark, kind):
    rows = spark.range(1000).repartition(7)
    df = rows.select(F.expr(KEYS[kind]).alias("k"), F.col("id").alias("v"))
    want = df.withColumn("n", F.row_number().over(Window.orderBy("k")).cast("int"))
    got = dense_key(df, "k", "n", rows_per_range=64)
    assert got.columns == ["n", "k", "v"]
    expected = want.select(got.columns).collect()
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in expected}


def test_dense_key_of_one_range_empty_and_null(spark):
    assert dense_key(spark.range(0), "id", "n").count() == 0
    df = spark.createDataFrame([(3,), (None,), (1,)], "k int")
    assert {tuple(r) for r in dense_key(df, "k", "n").collect()} == {(1, None), (2, 1), (3, 3)}
    split = dense_key(df, "k", "n", rows_per_range=1)
    assert {tuple(r) for r in split.collect()} == {(1, None), (2, 1), (3, 3)}


def test_dense_key_folds_repeated_keys_on_demand(spark):
    df = spark.createDataFrame([(5, "b"), (5, "a"), (2, "c")], "k int, v string")
    got = dense_key(df, "k", "n", unique=False)
    assert {tuple(r) for r in got.collect()} == {(1, 2, "c"), (2, 5, "a")}


def test_numbering_in_ranges_uses_no_single_task(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    plan = dense_key(df, "k", "n", rows_per_range=64)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a third without key, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, 42).when(F.col("id") % 3 == 1, F.col("id") % 500)
    return spark.range(30_000).select(key.cast("int").alias("k"), F.col("id").alias("v"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(400).select(F.col("id").cast("int").alias("k"), (-F.col("id")).alias("w"))


def test_hot_keys_finds_the_large_ones(skewed):
    assert hot_keys(skewed, ["k"])["k"] == {}
    found = hot_keys(skewed, ["k"], hot_rows=500)["k"]
    assert found == {42: 10_020, None: 10_000}
    sampled = hot_keys(skewed, ["k"], hot_rows=5_000)["k"]
    assert set(sampled) == {42, None} and 8_000 < sampled[42] < 12_000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_join(spark, skewed, dim, how):
    hot = {42: 10_020, None: 10_000, 7: 20}
    got = spread_join(skewed, dim, "k", how, hot, hot_rows=1_000)
    assert got.columns == skewed.join(dim, "k", how).columns
    want = skewed.join(dim, "k", how)
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty()


def test_lookup_with_hot_keys_equals_lookup(spark, skewed, dim):
    twice = dim.unionByName(dim.withColumn("w", F.col("w") - 1000))
    on, take = {"k": "k"}, {"w": "weight"}
    got = lookup(skewed, twice, on, take, hot={42: 10_020, None: 10_000})
    want = lookup(skewed, twice, on, take)
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).isEmpty()


def test_spread_join_cuts_the_hot_key(spark, skewed, dim):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        hot = {42: 10_020, None: 10_000}
        spread = spread_join(skewed, dim, "k", "left", hot, hot_rows=500)
        assert largest(spread) * 2 < largest(skewed.join(dim, "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_numbered_rows_are_not_sent_to_every_task(spark):
    df = spark.range(1000).select((F.col("id") * 3).alias("k"), F.lit("text").alias("v"))
    got = dense_key(df, "k", "n", rows_per_range=100)
    assert {r.n * 3 - 3 for r in got.collect()} == {r.k for r in got.collect()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "SortMergeJoin" not in plan
