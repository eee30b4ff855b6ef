"""Spans, joins by time and versions: registered queries against SQL, operators against brute force."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from history_queries import QUERIES, SQL
from pyspark.sql import functions as F
from starloom.operators.intervals import empty_spans, interval_join, merged_spans, span_gaps, span_overlaps
from starloom.operators.versions import merge_versions, version_at
from starloom.staging import settle
from test_oracle import FOLDER, duck, kind, rows  # noqa: F401


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):  # noqa: F811
    result, expected = QUERIES[name](spark, FOLDER), duck.sql(SQL[name])
    types = {f.name: kind(f.dataType.simpleString()) for f in result.schema.fields}
    assert types == {c: kind(str(t)) for c, t in zip(expected.columns, expected.types)}
    got, want = rows(result.columns, result.collect()), rows(expected.columns, expected.fetchall())
    assert want and got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


DAY = date(2000, 1, 1)


def day(n):
    return None if n is None else DAY + timedelta(days=n)


def some_spans(rng, n, longest, keys):
    out = []
    for k in range(n):
        a = rng.randrange(900)
        b = a + rng.choice((0, 0, 1, 3, 20, longest)) - (rng.random() < 0.05)
        out.append((rng.choice(keys), None if rng.random() < 0.05 else a, None if rng.random() < 0.1 else b, k))
    return out


def holds(span, other):
    low = lambda x: -(10**9) if x is None else x
    high = lambda x: 10**9 if x is None else x
    return max(low(span[1]), low(other[1])) <= min(high(span[2]), high(other[2])) and low(span[1]) <= high(span[2]) and low(other[1]) <= high(other[2])


def frame(spark, rows, prefix):
    schema = f"key string, {prefix}_from date, {prefix}_to date, {prefix}_id int"
    return spark.createDataFrame([(k, day(a), day(b), i) for k, a, b, i in rows], schema).repartition(3)


@pytest.mark.parametrize("seed, longest", [(1, 5), (2, 300), (3, 90)])
def test_points_meet_spans(spark, seed, longest):
    rng = random.Random(seed)
    keys = ["a"] * 6 + ["b", "c", None]
    spans = some_spans(rng, 300, longest, keys)
    points = [(rng.choice([*keys, "z"]), None if rng.random() < 0.1 else rng.randrange(-50, 1000), k) for k in range(400)]
    left = spark.createDataFrame([(k, day(t), i) for k, t, i in points], "key string, at date, id int")
    right = frame(spark, spans, "r")
    want = Counter(
        (i, s[3]) for k, t, i in points for s in spans
        if k is not None and t is not None and k == s[0] and holds((k, t, t), s)
    )
    met = {i for i, _ in want}
    for hot in (None, {"a": 300, None: 50}):
        joined = interval_join(left, right, ["key"], ("at", "at"), ("r_from", "r_to"), hot=hot, hot_rows=40)
        assert Counter((r.id, r.r_id) for r in joined.collect()) == want
        kept = interval_join(left, right, ["key"], ("at", "at"), ("r_from", "r_to"), "left", hot, 40)
        assert kept.columns == ["key", "at", "id", "r_from", "r_to", "r_id"]
        alone = Counter({(i, None): 1 for _, _, i in points if i not in met})
        assert Counter((r.id, r.r_id) for r in kept.collect()) == want + alone


@pytest.mark.parametrize("seed", [4, 5])
def test_spans_meet_spans(spark, seed):
    rng = random.Random(seed)
    one, two = (some_spans(rng, 250, n, ["a", "a", "a", "b", None]) for n in (200, 15))
    joined = interval_join(frame(spark, one, "l"), frame(spark, two, "r"), ["key"], ("l_from", "l_to"), ("r_from", "r_to"))
    want = Counter((x[3], y[3]) for x in one for y in two if x[0] is not None and x[0] == y[0] and holds(x, y))
    assert Counter((r.l_id, r.r_id) for r in joined.collect()) == want


def test_empty_tables_and_wrong_use(spark):
    points = spark.createDataFrame([("a", DAY, 1), (None, None, 2)], "key string, at date, id int")
    none = spark.createDataFrame([], "key string, r_from date, r_to date, r_id int")
    ends = (("at", "at"), ("r_from", "r_to"))
    assert interval_join(points, none, ["key"], *ends).count() == 0
    assert interval_join(points, none, ["key"], *ends, "left").count() == 2
    assert interval_join(points.limit(0), none, ["key"], *ends, "left").count() == 0
    some = frame(spark, [("a", 0, 5, 1)], "r")
    with pytest.raises(ValueError):
        interval_join(some, some.toDF("key", "a", "b", "c"), ["key"], ("r_from", "r_to"), ("a", "b"), "left")
    with pytest.raises(ValueError):
        interval_join(some, some, ["key"], ("r_from", "r_to"), ("r_from", "r_to"))
    with pytest.raises(TypeError):
        interval_join(some, points.withColumn("at", F.lit("x")), ["key"], ("r_from", "r_to"), ("at", "at"))


def test_join_by_time_is_an_equi_join(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = QUERIES["price_in_force"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" in plan


def brute_islands(spans):
    """Islands, gaps and overlaps of one key's (start, end) pairs in order."""
    islands, gaps, overlaps, reach = [], [], [], None
    for a, b in sorted(spans):
        if reach is not None and a <= reach:
            overlaps.append((a, min(b, reach)))
        if reach is None or a > reach + 1:
            if reach is not None:
                gaps.append((reach + 1, a - 1))
            islands.append([a, b, 0])
        islands[-1][1] = max(islands[-1][1], b)
        islands[-1][2] += 1
        reach = b if reach is None else max(reach, b)
    return islands, gaps, overlaps


@pytest.mark.parametrize("seed", [6, 7])
def test_islands_over_ranges_and_a_hot_key(spark, seed):
    """One key has most rows, equal spans among them; null keys and open ends take part."""
    rng = random.Random(seed)
    rows = some_spans(rng, 700, 40, ["hot"] * 8 + ["b", None]) + [("hot", 100, 120, 0)] * 200 + [("x", 5, 6, 0)]
    df = frame(spark, rows, "s").repartition(6)
    span, far = ("s_from", "s_to"), 10**6
    by_key = {}
    for k, a, b, _ in rows:
        a, b = -far if a is None else a, far if b is None else b
        if a <= b:
            by_key.setdefault(k, []).append((a, b))
    end = lambda n: None if abs(n) >= far else day(n)
    want = {k: brute_islands(v) for k, v in by_key.items()}
    got = Counter((r.key, r.s_from, r.s_to, r.Rows) for r in merged_spans(df, ["key"], span).collect())
    assert got == Counter((k, end(a), end(b), n) for k, w in want.items() for a, b, n in w[0])
    got = Counter(tuple(r) for r in span_gaps(df, ["key"], span).collect())
    assert got == Counter((k, end(a), end(b)) for k, w in want.items() for a, b in w[1])
    got = Counter(tuple(r) for r in span_overlaps(df, ["key"], span).collect())
    assert got == Counter((k, end(a), end(b)) for k, w in want.items() for a, b in w[2])
    assert empty_spans(df, span).count() == sum(a is not None and b is not None and b < a for _, a, b, _ in rows)
    assert merged_spans(df.limit(0), ["key"], span).count() == 0


def test_times_and_numbers_are_spans_too(spark):
    at = datetime(2020, 1, 1, 12, 0, 0, 5)
    rows = [(1, at, at + timedelta(microseconds=3), 1, 4), (1, at + timedelta(microseconds=4), None, 5, None), (2, at, at, 7, 7)]
    df = spark.createDataFrame(rows, "k int, a timestamp, b timestamp, c bigint, d bigint")
    times = {(r.k, r.a, r.b, r.Rows) for r in merged_spans(df, ["k"], ("a", "b")).collect()}
    assert times == {(1, at, None, 2), (2, at, at, 1)}
    numbers = {(r.k, r.c, r.d, r.Rows) for r in merged_spans(df, ["k"], ("c", "d")).collect()}
    assert numbers == {(1, 1, None, 2), (2, 7, 7, 1)}


# versions -------------------------------------------------------------------------------------


def snapshot_of(spark, rows):
    return spark.createDataFrame(rows, "id int, name string, city string")


def merged(held, df, n, **options):
    return merge_versions(held, df, ["id"], day(n), "no", **options)


def table(df):
    return sorted((r.no, r.id, r.name, r.city, r.ValidFrom and (r.ValidFrom - DAY).days, r.ValidTo and (r.ValidTo - DAY).days) for r in df.collect())


def test_versions_open_close_and_come_back(spark):
    first = merged(None, snapshot_of(spark, [(1, "a", "x"), (2, "b", None), (None, "n", "")]), 0)
    assert table(first) == [(1, None, "n", "", None, None), (2, 1, "a", "x", None, None), (3, 2, "b", None, None, None)]
    # 2 gets an empty city for none, 3 is new, the null key goes
    second = snapshot_of(spark, [(1, "a", "x"), (2, "b", ""), (3, "c", "z")])
    held = merged(first, second, 10, close_missing=True)
    want = [
        (1, None, "n", "", None, 9), (2, 1, "a", "x", None, None), (3, 2, "b", None, None, 9),
        (4, 2, "b", "", 10, None), (5, 3, "c", "z", 10, None),
    ]
    assert table(held) == want
    assert table(merged(held, second, 10, close_missing=True)) == want
    assert table(merged(held, second, 11, close_missing=True)) == want
    # on the same day: a correction keeps its number, a new row that goes again was never there
    again = merged(held, snapshot_of(spark, [(1, "a", "x"), (2, "B", "")]), 10, close_missing=True)
    assert table(again) == [*want[:3], (4, 2, "B", "", 10, None)]
    # the values of the day before come again: the version that was closed for them is open again
    undone = merged(held, snapshot_of(spark, [(None, "n", ""), (1, "a", "x"), (2, "b", None)]), 10, close_missing=True)
    assert table(undone) == table(first)
    # what is not in the snapshot stays, unless missing keys are closed; closed keys come back
    back = merged(held, snapshot_of(spark, [(None, "n", "")]), 20)
    assert table(back) == [*want, (6, None, "n", "", 20, None)]


def test_versions_refuse_what_would_be_wrong(spark):
    held = merged(None, snapshot_of(spark, [(1, "a", "x")]), 0, since=day(5))
    with pytest.raises(ValueError, match="order of their days"):
        merged(held, snapshot_of(spark, [(1, "b", "x")]), 4)
    with pytest.raises(Exception, match="occurs twice"):
        merged(held, snapshot_of(spark, [(1, "b", "x"), (1, "c", "x")]), 9)
    with pytest.raises(ValueError, match="ValidTo"):
        merged(held, snapshot_of(spark, [(1, "b", "x")]).withColumn("ValidTo", F.lit(1)), 9)
    assert merged(held, snapshot_of(spark, []), 9).count() == 1
    assert merged(None, snapshot_of(spark, []), 9).count() == 0


@pytest.mark.parametrize("seed", [8, 9])
def test_random_snapshots_read_back_at_every_day(spark, seed):
    """Whatever was in a snapshot is what ``version_at`` gives until the next one."""
    rng, held, taken = random.Random(seed), None, {}
    for n in (0, 10, 20, 30):
        rows = [(k, rng.choice("ab"), rng.choice(["x", "", None])) for k in range(60) if rng.random() < 0.8]
        held, taken[n] = merged(held, snapshot_of(spark, rows), n, since=day(0), close_missing=True), dict((r[0], r[1:]) for r in rows)
    facts = spark.createDataFrame([(k, day(n + d)) for k in range(60) for n in taken for d in (0, 9)], "id int, at date")
    for how in ("left", "inner"):
        out = version_at(facts, held, ["id"], "at", ["name", "city", "no"], how).collect()
        seen = {(r.id, r.at): (r.name, r.city) for r in out if r.no is not None}
        assert seen == {(k, day(n + d)): v for n, rows in taken.items() for k, v in rows.items() for d in (0, 9)}
        assert len(out) == (480 if how == "left" else len(seen))
    numbers = [r.no for r in held.collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_versions_are_shuffled_once(spark, monkeypatch):
    """Closed versions are read, not shuffled; there is no join."""
    from starloom.operators import versions

    plans = []
    monkeypatch.setattr(versions, "settle", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or settle(df, name))
    held = merged(None, snapshot_of(spark, [(k, "a", "x") for k in range(50)]), 0)
    plans.clear()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged(held, snapshot_of(spark, [(k, "b", "x") for k in range(50)]), 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_name = dict(plans)
    assert by_name["merged_versions"].count("Exchange hashpartitioning") == 1
    assert "Join" not in by_name["merged_versions"]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_many_spans_are_not_sent_to_every_task(spark, monkeypatch, how):
    points = spark.range(400).select(
        F.concat(F.lit("k"), F.col("id") % 7).alias("key"), F.date_add(F.lit(DAY), (F.col("id") % 90).cast("int")).alias("at")
    )
    # a row of the file makes many spans, which Spark does not see in the file's size
    held = settle(spark.range(7).select(F.concat(F.lit("k"), F.col("id")).alias("key"), "id"), "keys")
    begin = F.date_add(F.lit(DAY), (F.col("j") * 9 + F.col("id")).cast("int"))
    spans = held.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(9)))).select(
        "key", begin.alias("from"), F.date_add(begin, F.col("j") * 2).alias("to")
    )
    plain = Counter(map(tuple, interval_join(points, spans, ["key"], ("at", "at"), ("from", "to"), how).collect()))
    monkeypatch.setattr("starloom.operators.intervals.FEW_SPANS", 20)
    many = interval_join(points, spans, ["key"], ("at", "at"), ("from", "to"), how)
    assert "BroadcastHashJoin" not in many._jdf.queryExecution().executedPlan().toString()
    assert Counter(map(tuple, many.collect())) == plain
