"""The pipeline stage by stage, each on its predecessor's result."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from starloom.staging import settle

from test_operators import brute_texts, check_pieces, edge_rows, SCHEMA


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, folder), name)
        out.append((name, docs))
    return dict(out)


def test_order_and_columns(stages):
    assert list(stages) == ["documents", "quality", "near_duplicates", "pii", "mixing", "packing"]
    for name in list(stages)[1:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_bad_documents_go_and_good_ones_stay(spark, stages, folder):
    kept = {r.doc_id for r in stages["quality"].select("doc_id").collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    good = [r.doc_id in kept for r in labels if r.quality == 1]
    bad = [r.doc_id not in kept for r in labels if r.quality == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) > 0.9


def test_one_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages["quality"].collect()]
    want = {r[0] for r in brute_texts(rows, 80) if r[3]}
    assert {r.doc_id for r in stages["near_duplicates"].collect()} == want


def test_no_personal_data(stages):
    before = {r.doc_id: r.text for r in stages["near_duplicates"].collect()}
    value = re.compile(r"[a-z]+\.\d+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}")
    for r in stages["pii"].collect():
        assert len(r.text) == len(before[r.doc_id])
        assert not any(v in r.text for v in value.findall(before[r.doc_id]))


def test_mix_takes_rows_up_to_twice(stages):
    before = {r.doc_id: r for r in stages["pii"].collect()}
    taken = Counter(r.doc_id for r in stages["mixing"].collect())
    assert max(taken.values()) <= 2 and set(taken) <= set(before)


def test_packed_ids_are_the_texts(stages):
    once = stages["mixing"].groupBy("doc_id").agg(F.count("*").alias("n"), F.first("text").alias("text"))
    single = {r.doc_id: r.text for r in once.where("n = 1").collect()}
    rows = [r for r in stages["packing"].collect() if r.doc_id in single]
    check_pieces(rows, single, 4096)


def test_run_is_the_last_stage(spark, folder, stages):
    columns = [c for c in stages["packing"].columns if c != "sequence_id"]
    got = Counter(tuple(map(bytes_or, r)) for r in corpus_pipeline.run(spark, folder).select(columns).collect())
    assert got == Counter(tuple(map(bytes_or, r)) for r in stages["packing"].select(columns).collect())


def bytes_or(value):
    return bytes(value) if isinstance(value, bytearray) else value


def test_stages_take_edges(spark, folder):
    docs = spark.createDataFrame(edge_rows(), SCHEMA).withColumn("_quality", F.lit(1))
    for start in (docs, docs.limit(0)):
        current = start
        for name, stage in corpus_pipeline.STAGES:
            current = settle(stage(spark, current, folder), f"edge_{name}")
        assert (current.count() > 0) == (start is docs)
