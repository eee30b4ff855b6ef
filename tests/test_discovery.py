"""Keys and references found in tables, against sets."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from starloom.operators.discovery import candidate_keys, column_values, comparable, inclusions, references


def brute(tables):
    """Values of each column with their counts, kinds told by Python's own types."""
    out = {}
    for name, (columns, rows) in tables.items():
        for i, c in enumerate(columns):
            out[f"{name}.{c}"] = [r[i] for r in rows]
    return out


@pytest.fixture(scope="module")
def small(spark):
    rng = random.Random(4)
    parents = [(k, f"n{k}", Decimal(k) / 2) for k in range(40)]
    children = [
        (k, rng.randrange(40) if rng.random() < 0.9 else None, rng.choice(["n1", "n2", "x"]), 7 if rng.random() < 0.6 else k)
        for k in range(300)
    ]
    frames = {
        "p": spark.createDataFrame(parents, "id int, name string, half decimal(9,1)"),
        "c": spark.createDataFrame(children, "id bigint, p_id bigint, name string, many bigint").repartition(5),
        "none": spark.createDataFrame([], "id int, name string"),
    }
    plain = {"p": (["id", "name", "half"], parents), "c": (["id", "p_id", "name", "many"], children), "none": (["id", "name"], [])}
    return frames, brute(plain)


def test_keys(small):
    frames, plain = small
    rows = {f"{r.TableName}.{r.ColumnName}": r for r in candidate_keys(column_values(frames), frames).collect()}
    assert set(rows) == set(plain)
    for name, values in plain.items():
        known, r = [v for v in values if v is not None], rows[name]
        repeated = sum(known.count(v) > 1 for v in set(known))
        assert (r.Rows, r.Nulls, r.Values, r.Repeated) == (len(values), len(values) - len(known), len(set(known)), repeated)
        assert r.IsKey == (len(values) > 0 and len(set(known)) == len(values))


@pytest.mark.parametrize("share", [1.0, 0.5, 0.01])
def test_inclusions(small, share):
    frames, plain = small
    got = {(r.ChildColumn, r.ParentColumn): (r.Values, r.Shared, r.ChildRows, r.SharedRows) for r in inclusions(column_values(frames), share).collect()}
    want = {}
    for a, x in plain.items():
        x = [v for v in x if v is not None]
        for b, y in plain.items():
            both = {v for v in set(x) & set(y) if v is not None}
            if a != b and both and len(both) >= share * len(set(x)):
                want[a, b] = (len(set(x)), len(both), len(x), sum(v in both for v in x))
    assert got == want


def test_references_name_the_rows_that_break_them(small):
    frames, _ = small
    values = column_values(frames)
    found = {(r.ChildColumn, r.ParentColumn): r.BrokenRows for r in references(values, frames, 0.6).collect()}
    assert found["c.p_id", "p.id"] == 0 and found["c.name", "p.name"] > 0
    assert all(parent.split(".")[1] in ("id", "name", "half") for _, parent in found)


def test_kinds_of_values(spark):
    """Equal numbers of any width, days and midnights are equal; texts of digits are no numbers."""
    df = spark.createDataFrame(
        [(1, Decimal("1.00"), "1", 1.0, date(2020, 1, 1), datetime(2020, 1, 1), True, [1])],
        "a int, b decimal(5,2), c string, d double, e date, f timestamp, g boolean, h array<int>",
    )
    assert comparable(df) == list("abcdefg")
    pairs = {(r.ChildColumn[2:], r.ParentColumn[2:]) for r in inclusions(column_values({"t": df})).collect()}
    assert pairs == {("a", "b"), ("b", "a"), ("e", "f"), ("f", "e")}
    odd = df.select(F.lit(Decimal("0.00")).alias("z"), F.lit(0).alias("y"), F.lit(100).alias("x"), F.lit(Decimal("1E+2")).alias("w"))
    pairs = {(r.ChildColumn[2:], r.ParentColumn[2:]) for r in inclusions(column_values({"t": odd})).collect()}
    assert pairs == {("z", "y"), ("y", "z"), ("x", "w"), ("w", "x")}


def test_a_common_value_is_counted_before_it_is_shuffled(spark):
    """Two hash exchanges over counted values, no join of tables, no sort of rows."""
    df = spark.range(1000).select(F.lit(1).alias("same"), F.col("id"))
    from starloom.operators import discovery

    plans = []
    real = discovery.settle
    discovery.settle = lambda d, n: plans.append(d._jdf.queryExecution().executedPlan().toString()) or real(d, n)
    try:
        column_values({"t": df, "u": df})
    finally:
        discovery.settle = real
    assert "Join" not in plans[0] and plans[0].count("Exchange hashpartitioning") == 2


def test_values_become_texts_once_a_value(spark, monkeypatch):
    from starloom.operators import discovery

    plans = []
    real = discovery.settle
    keep = lambda d, n: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or real(d, n)
    monkeypatch.setattr(discovery, "settle", keep)
    df = spark.range(50).select("id", F.timestamp_seconds(F.col("id") % 3).alias("at"), (F.col("id") % 2 * -0.0).alias("x"))
    values = {(r.Kind, r.Value): {c.Column: c.Rows for c in r.Columns} for r in column_values({"t": df}).collect()}
    assert len(values) == 50 + 3 + 1 and values["real", "0.0"] == {"t.x": 50}
    assert values["time", "1970-01-01 00:00:02.000000"] == {"t.at": 16}
    lines = plans[0].splitlines()
    counted = max(k for k, line in enumerate(lines) if "Aggregate" in line)
    assert any("date_format" in line for line in lines[: counted + 1])
    assert "date_format" not in lines[counted].split("], [")[0]  # what is counted by
    assert not any("date_format" in line for line in lines[counted + 1 :])
