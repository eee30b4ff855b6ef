"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    conversations, merkle, minhash, mixing, packing, pii, quality, repeats, secrets, tokens, topk,
    urls, vecdedup,
)


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer file lies; its place is the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


#: The URL rules as (verdict, host, path).
URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]
TOKEN_LIMIT = 4096
END_ID = 2
QUALITY_LIMIT = 0.7
#: The key of the registered queries; a real run takes its own from a secret store.
PII_KEY = b"registered query"


def op2_prefix_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    # the text's size travels with its id: it takes the place of no other column
    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = tokens.count_tokens(
        sized, tokenizer_path("piece_bpe_32k.model"), TOKEN_LIMIT, keep=["n_bytes"]
    )
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
        "fit_chars",
    )


def op1_feistel_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, PII_KEY, count="n_replaced")


def op3_run_length_repeats(spark: SparkSession, folder: str) -> DataFrame:
    removed = repeats.remove_repeats(read(spark, folder, "documents").select("doc_id", "text"), 200)
    return removed.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_cross_polytope_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vecdedup.near_vectors(read(spark, folder, "embeddings"), 0.98)


def op5_nb_svm_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, read(spark, folder, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= QUALITY_LIMIT).cast("int").alias("predicted"),
    )


def op6_power_of_two_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), END_ID, TOKEN_LIMIT)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op7_histogram_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op8_redirect_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(read(spark, folder, "pages"), urls.rules_table(spark, URL_RULES))


def op9_hash_threshold_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"), (5, 2, 1), 1.5, 2.0)


def op10_densified_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_texts(read(spark, folder, "documents").select("doc_id", "text"), 85)


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(read(spark, folder, "documents"))


def op12_grammar_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *(secrets.count(F.col("base"), k).alias(f"n_{k}") for k in secrets.KINDS),
        F.sha2(secrets.said(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.said(secrets.in_order(F.col("base"), F.col("added"))).alias("spans"),
    )


def op13_lr_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.report(conversations.damage(read(spark, folder, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_feistel_pii, op2_prefix_token_counts, op3_run_length_repeats,
        op4_cross_polytope_vectors, op5_nb_svm_quality, op6_power_of_two_packing,
        op7_histogram_top_k, op8_redirect_url_filter, op9_hash_threshold_mixing,
        op10_densified_minhash, op11_merkle_manifest,
        op12_grammar_secret_scan, op13_lr_conversation_repair,
    )
}
