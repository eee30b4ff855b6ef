"""Manifest trees and proofs against a plain recursive version."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from starloom.llm import merkle

from test_operators import CLASHES, LOWER, SCHEMA, edge_rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    doc, _, lang, source, n = row
    return sha("".join(
        "-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)
    ))


def null_first(value, low):
    return (value is not None, value if value is not None else low)


def tree(level):
    """All levels, from the leaves to the one root."""
    levels = [level]
    while len(level) > 1:
        level = [sha("".join(level[k : k + 8])) for k in range(0, len(level), 8)]
        levels.append(level)
    return levels


def climb(levels, at, value):
    proof = []
    for level in levels[:-1]:
        low = at // 8 * 8
        run = level[low : low + 8]
        proof += run[: at - low] + run[at - low + 1 :]
        value = sha("".join([*run[: at - low], value, *run[at - low + 1 :]]))
        at //= 8
    return proof, value


def brute(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append((null_first(row[0], 0), leaf_of(row, row[1]), row))
    langs = sorted(by_lang, key=lambda x: null_first(x and x.encode(), b""))
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[:2])
    trees = {lang: tree([x[1] for x in by_lang[lang]]) for lang in langs}
    top = tree([trees[lang][-1][0] for lang in langs]) if langs else []
    out = []
    for k, lang in enumerate(langs):
        for at, (_, leaf, row) in enumerate(by_lang[lang]):
            start = leaf
            if row[0] is not None and row[1] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                start = leaf_of(row, row[1].translate(LOWER))
            low, value = climb(trees[lang], at, start)
            high, value = climb(top, k, value)
            root = top[-1][0]
            out.append((row[0], leaf, trees[lang][-1][0], root, sha("".join(low + high)), value, value == root))
    return out


def got(df):
    return Counter(tuple(r) for r in merkle.manifest(df).collect())


def test_edge_rows(spark):
    rows = edge_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit(7) for c in [*CLASHES, "grp", "rank", "digest", "_grp", "path"]}
    )
    assert got(df) == Counter(brute(rows))
    assert got(df.limit(0)) == Counter()


@pytest.mark.parametrize("n, langs", [(1, 1), (8, 1), (9, 1), (64, 2), (65, 1), (700, 12), (90, 90)])
def test_every_tree_shape(spark, n, langs):
    rng = random.Random(n)
    rows = [
        (k * 7 - 30, f"Text {rng.random()} Ä", f"l{min(rng.randrange(langs), rng.randrange(langs))}", "s", k)
        for k in range(n)
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df) == Counter(brute(rows))


def test_repeated_rows_of_one_id(spark):
    rows = [(1, "Same", "en", "s", 4)] * 300 + [(2, "other", "en", "s", 5), (None, "Same", None, None, None)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == Counter(brute(rows))


def test_few_requests_open_few_records(spark):
    """Requests take their own leaves and paths; beyond the last leaf there is nothing."""
    values = [sha(str(k)) for k in range(600)]
    leaves = spark.createDataFrame([("g", k, v) for k, v in enumerate(values)], "grp string, rank bigint, digest string")
    forest = merkle.build(leaves)
    wanted = spark.createDataFrame([("g", 0), ("g", 599), ("g", 599), ("g", 77), ("g", 600), ("h", 0)], "grp string, rank bigint")
    found = merkle.descend(forest, wanted).withColumn("root", merkle.fold(F.col("found"), F.col("path")))
    rows = found.collect()
    assert sorted(r["rank"] for r in rows) == [0, 77, 599, 599]
    levels = tree(values)
    for r in rows:
        proof, root = climb(levels, r["rank"], values[r["rank"]])
        assert r["found"] == values[r["rank"]] and r["root"] == root == levels[-1][0]
        assert "".join(x["before"] + x["after"] for x in r["path"]) == "".join(proof)


def test_ranks_over_many_ranges(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 5000).alias("v"))
    out = merkle.ranked(rows.repartition(7), "g", ["v"], "place").collect()
    for g in range(3):
        mine = sorted((r["v"], r["place"]) for r in out if r["g"] == g)
        assert [p for _, p in mine] == list(range(len(mine)))
