"""Types found from texts, against plain Python."""

import random
import re
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from starloom.operators.inference import TYPES, breaking_rows, fits, inferred_types, merged_state, type_state


def python_fits(text, kind):
    whole = re.fullmatch(r"-?(0|[1-9][0-9]*)", text)
    number = re.fullmatch(r"-?(0|[1-9][0-9]*)(\.[0-9]+)?", text)

    def reads(how, value):
        try:
            return bool(how(value))
        except ValueError:
            return False

    if kind == "bit":
        return text in ("0", "1")
    if kind == "int":
        return bool(whole) and -(2**31) <= int(text) < 2**31
    if kind == "bigint":
        return bool(whole) and -(2**63) <= int(text) < 2**63
    if kind == "decimal":
        return bool(number) and sum(c.isdigit() for c in text) <= 38
    day = bool(re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", text)) and reads(date.fromisoformat, text)
    time = re.fullmatch(r"([0-9-]{10})[ T]([0-9:]{8})(\.[0-9]{1,9})?", text)
    return day if kind == "date" else day or bool(time) and reads(datetime.fromisoformat, f"{time[1]} {time[2]}")


VALUES = [
    "0", "1", "-1", "7", "007", "+5", "2147483647", "2147483648", "-9223372036854775808", "9223372036854775808",
    "1.50", "-0.5", ".5", "5.", "1e5", "9" * 38, "9" * 39, "1." + "0" * 37, "1." + "0" * 38, "2020-02-29", "2021-02-29", "2020-13-01",
    "2020-02-29 23:59:59", "2020-02-29T00:00:00.123456789", "2020-02-29 24:00:00", "2020-02-29 1:00:00", "x", " 1", "１", "-", "NaN",
]


def test_single_values(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    rows = df.select("v", *[F.coalesce(fits(F.col("v"), t), F.lit(False)).alias(t) for t in TYPES]).collect()
    for r in rows:
        assert {t: r[t] for t in TYPES} == {t: python_fits(r.v, t) for t in TYPES}, r.v
    with pytest.raises(ValueError):
        fits(F.col("v"), "money")


def python_type(values):
    known = [v for v in values if v]
    if not known:
        return "null"
    numbers = [re.fullmatch(r"-?([0-9]+)(?:\.([0-9]+))?", v) for v in known if python_fits(v, "decimal")]
    digits, scale = (max((len(m[k] or "") for m in numbers), default=0) for k in (1, 2))
    for t in TYPES:
        if all(python_fits(v, t) for v in known) and (t != "decimal" or digits + scale <= 38):
            return f"decimal({digits + scale},{scale})" if t == "decimal" else t
    return f"varchar({max(map(len, known))})"


@pytest.mark.parametrize("seed", range(2))
def test_states_merge_in_any_order(spark, seed):
    rng = random.Random(seed)
    pools = [["0", "1"], ["0", "", None], ["5", "12", "-3"], ["5", "99999999999"], ["1.25", "100", "-7.5"], ["9" * 30, "1." + "0" * 20],
             ["2020-01-01", "1999-12-31"], ["2020-01-01", "2020-01-01 10:00:00"], ["7", "2020-01-01"], ["a", "1"], [None, ""], ["00", "1"]]
    columns = [f"c{k}" if k else "a.b" for k in range(len(pools))]
    rows = [tuple(rng.choice(p) for p in pools) for _ in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))
    whole = {r.ColumnName: r for r in inferred_types(type_state(df)).collect()}
    parts = [type_state(spark.createDataFrame(rows[a::3], df.schema)) for a in (2, 0, 1)]
    merged = inferred_types(merged_state(parts[0].union(parts[1]).union(parts[2]).union(type_state(df.limit(0)))))
    assert Counter(map(tuple, merged.collect())) == Counter(map(tuple, whole.values()))
    for k, c in enumerate(columns):
        values = [r[k] for r in rows]
        assert whole[c].Type == python_type(values) and whole[c].Empty == sum(not v for v in values)
    found = breaking_rows(df, "c8", "int").collect()
    assert len(found) == sum(r[8] == "2020-01-01" for r in rows)
    assert type_state(df.limit(0)).count() == 0
    assert {r.ColumnName for r in type_state(df, ["c1"]).collect()} == {"c1"}


def test_states_look_at_a_text_once_for_each_pattern(spark):
    """The same counts as ``fits`` gives, without reading each text again for every type."""
    odd = [*VALUES, "12\n", "1.5\r\n", "2020-01-01\n", "2020-01-01 10:00:00\r\n", "-0", "999999999", "9" * 18, "2147483648", "-2147483649"]
    df = spark.createDataFrame([(v,) for v in odd], "v string")
    one = type_state(df)
    state = one.collect()[0]
    value = F.when(F.col("v") != "", F.col("v"))
    for t in TYPES:
        assert state[f"Not_{t}"] == df.where(value.isNotNull() & ~F.coalesce(fits(value, t), F.lit(False))).count(), t
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 3 and "regexp_extract" not in plan
