"""Loads that appear whole or not at all, whatever step they die at."""

import os

import pytest
from pyspark.sql import functions as F
from starloom.plans.increments import KeptReports
from starloom.plans.star import reports, run_warehouse
from starloom.sinks import AtomicStore, atomic
from starloom.sinks.files import write_parquet
from starloom.sources.retail import retail_source

FOLDER = "/root/testdata/sf0.001"


class Died(Exception):
    pass


class Steps:
    """Counts writes and renames; dies before or behind the given one."""

    def __init__(self, monkeypatch, at=0, behind=False):
        self.done, self.at, self.behind = 0, at, behind
        publish = atomic.Folder.publish
        monkeypatch.setattr(atomic, "write_parquet", self.step(write_parquet))
        monkeypatch.setattr(atomic.Folder, "publish", self.step(publish))

    def step(self, act):
        def run(*args, **kwargs):
            self.done += 1
            if self.done == self.at and not self.behind:
                raise Died
            out = act(*args, **kwargs)
            if self.done == self.at:
                raise Died
            return out

        return run


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int").coalesce(1)


def values(store, spark, name):
    df = store.read(spark, name)
    return None if df is None else sorted(r.v for r in df.collect())


def one_load(store, spark):
    load = store.begin(spark)
    load("a", numbers(spark, 7), "overwrite")
    load("b", numbers(spark, 8), "append")
    load.keys.write("k", numbers(spark, 9), "append")
    load.publish()


@pytest.mark.parametrize("behind", [False, True])
@pytest.mark.parametrize("at", [1, 2, 3, 4])
def test_a_load_that_dies_at_any_step_is_not_there(spark, tmp_path, monkeypatch, at, behind):
    store = AtomicStore(f"{tmp_path}/s")
    first = store.begin(spark)
    first("a", numbers(spark, 1), "overwrite")
    first("b", numbers(spark, 2), "append")
    first("c", numbers(spark, 3), "overwrite")
    first.publish()
    with monkeypatch.context() as patched:
        Steps(patched, at, behind)
        with pytest.raises(Died):
            one_load(store, spark)
    published = at == 4 and behind
    assert values(store, spark, "a") == ([7] if published else [1])
    assert values(store, spark, "b") == ([2, 8] if published else [2])
    if not published:
        one_load(store, spark)
    assert values(store, spark, "a") == [7] and values(store, spark, "b") == [2, 8]
    assert values(store, spark, "c") == [3] and values(store, spark, "keys_k") == [9]
    # what the dead load has left is gone when the next one begins
    store.begin(spark)
    named = {f for n in store.manifests(spark) for fs in store.manifest(spark, n).tables.values() for f in fs}
    there = {f"_loads/{x}/{t}" for x in os.listdir(f"{tmp_path}/s/_loads") for t in os.listdir(f"{tmp_path}/s/_loads/{x}")}
    assert there == named
    assert not [n for n in os.listdir(f"{tmp_path}/s/_manifests") if n.endswith(".new")]


def test_readers_of_the_load_before_can_go_on(spark, tmp_path):
    store = AtomicStore(f"{tmp_path}/s")
    assert store.read(spark, "a") is None and store.manifests(spark) == []
    for k in range(4):
        load = store.begin(spark)
        load("a", numbers(spark, k), "overwrite")
        old = store.read(spark, "a")
        load.publish()
        assert values(store, spark, "a") == [k]
        assert old is None or [r.v for r in old.collect()] == [k - 1]
    assert store.manifests(spark) == [2, 3, 4]
    assert [r.v for r in store.read(spark, "a", 3).collect()] == [2]


def test_two_loads_at_once_do_not_both_appear(spark, tmp_path):
    store = AtomicStore(f"{tmp_path}/s")
    one, two = store.begin(spark), store.begin(spark)
    one("a", numbers(spark, 1), "append")
    two("a", numbers(spark, 2), "append")
    one.publish()
    with pytest.raises(Exception, match="(?i)exist"):
        two.publish()
    assert values(store, spark, "a") == [1]
    with pytest.raises(ValueError):
        one("a", numbers(spark, 1), "append")
    with pytest.raises(ValueError):
        one("b", numbers(spark, 1), "ignore")


def state(store, spark):
    star = {n: store.read(spark, n) for n in ("DimCustomer", "DimProduct", "DimGeography", "DimDate", "FactCustomSales")}
    sums = {n: df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first() for n, df in star.items()}
    return {n: tuple(row) for n, row in sums.items()}


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    store = AtomicStore(str(tmp_path_factory.mktemp("clean")))
    run_warehouse(retail_source(spark, FOLDER), store.begin(spark), "narrow", mode="append", ids="bigint")
    return state(store, spark)


@pytest.mark.parametrize("at", range(1, 11))
def test_a_star_that_dies_at_any_step_loads_to_the_same_rows(spark, tmp_path, monkeypatch, clean, at):
    """Key maps, dimensions, fact, the fact's key map, the rename: whichever is the last thing done."""
    store, source = AtomicStore(f"{tmp_path}/s"), retail_source(spark, FOLDER)
    with monkeypatch.context() as patched:
        steps = Steps(patched, at, behind=True)
        with pytest.raises(Died):
            run_warehouse(source, store.begin(spark), "narrow", mode="append", ids="bigint")
        assert steps.done == at
    assert bool(store.manifests(spark)) == (at == 10)
    run_warehouse(source, store.begin(spark), "narrow", mode="append", ids="bigint")
    assert state(store, spark) == clean


def test_job_builds_into_the_store(spark, tmp_path):
    from warehouse_job import arguments, run

    run(spark, arguments(["build", "--tables", FOLDER, "--out", str(tmp_path), "--model", "narrow", "--atomic", "--ids", "bigint"]))
    assert AtomicStore(f"{tmp_path}/narrow").read(spark, "FactCustomSales").count() > 0
    with pytest.raises(SystemExit):
        arguments(["load", "--tables", FOLDER, "--out", str(tmp_path), "--atomic"])


def totals(reports):
    return {name: {tuple(r) for r in df.collect()} for name, df in reports.items()}


def test_kept_reports_follow_every_load(spark, tmp_path):
    """After each step the sums give what the whole fact gives: appends, a repeat, a withdrawn load, its
    second coming, a withdrawal after compaction."""
    source, model = retail_source(spark, FOLDER), "narrow"
    store, kept = AtomicStore(f"{tmp_path}/s"), KeptReports(model)

    def half(name):
        df = source(name)
        return df.where("CustomerID % 2 = 1") if name == "Customer" else df

    def check():
        star = {n: store.read(spark, n) for n in ("DimProduct", "DimGeography", "DimDate", "FactCustomSales")}
        assert totals(kept.reports(store, spark)) == totals(reports(star, model))
        return star["FactCustomSales"].count()

    def load(tables):
        one, published = store.begin(spark), {}
        run_warehouse(tables, one, model, published.__setitem__, "append", "bigint", kept=kept)
        assert totals(published) == totals(kept.reports(store, spark))
        return one.name

    def change(act, *args):
        one = store.begin(spark)
        act(one, *args)
        one.publish()

    first, some = load(half), check()
    second, whole = load(source), check()
    assert 0 < some < whole
    load(source)
    assert check() == whole
    change(kept.withdraw, second)
    assert check() == some
    third = load(source)
    assert check() == whole
    change(kept.compact)
    assert check() == whole and len(store.manifest(spark).tables["sums_DateKey"]) == 1
    change(kept.withdraw, third)
    assert check() == some
    assert {r.Load for r in kept.lines(store, spark).where("Lines > 0").collect()} == {first}
    with pytest.raises(ValueError):
        kept.withdraw(store.begin(spark), third)
    with pytest.raises(ValueError):
        run_warehouse(source, lambda *a: None, model, kept=kept)
