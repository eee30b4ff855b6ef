"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``run`` writes
each result as Parquet in the shared folder and reads it again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import minhash, mixing, packing, pii, quality
from starloom.llm.queries import END_ID, PII_KEY, QUALITY_LIMIT, TOKEN_LIMIT, read, tokenizer_path
from starloom.staging import settle


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.7 or more; it learns from the labelled ones."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    name = "_quality"
    while name in docs.columns:
        name += "_"
    return quality.score(docs, model, name).where(F.col(name) >= QUALITY_LIMIT).drop(name)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at similarity 0.8 that of the smallest id."""
    return minhash.keep_one(docs, 80)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms of the same format; lengths stay."""
    return pii.pseudonymize(docs, PII_KEY)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them, none over twice."""
    return mixing.mixed(docs, (5, 2, 1), 1.5, 2.0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length, each a sequence of its own."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), END_ID, TOKEN_LIMIT)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("near_duplicates", one_of_near_duplicates),
    ("pii", pseudonyms),
    ("mixing", source_mix),
    ("packing", packed),
]

#: Stages of shingle sets, fitted models and keyed permutations are not SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
