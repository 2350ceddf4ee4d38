"""Thin queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bytebpe, centroids, embeddings, langid, lm, mixing, oracles, packing, quality,
               repair, simhash, urls, warc, wordpiece)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(_table(spark, sf_dir, "documents"),
                                  tokenizer_path("word_bpe_49k.json"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("copies")


def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"))


def warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


#: The list of the URL query's contract.
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"),
             ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, URL_RULES))
                      + " AS t(host, path, action)")
    return urls.judge_urls(_table(spark, sf_dir, "pages"), rules)


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(_table(spark, sf_dir, "conversations"))


def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(*centroids.cluster(_table(spark, sf_dir, "embeddings")))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tokenizer_path("byte_bpe_50k.tiktoken")
    decoded = bytebpe.decode(bytebpe.encode(_table(spark, sf_dir, "documents"), ranks), ranks)
    return decoded.select(
        "doc_id", (F.octet_length("input_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("input_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_best_fit_packing": best_fit_packing,
    "op2_simhash_near_dedup": simhash_near_dedup,
    "op3_embedding_near_dedup": embedding_near_dedup,
    "op4_quality_rules": quality_rules,
    "op5_token_counts": token_counts,
    "op6_language_id": language_id,
    "op7_url_filters": url_filters,
    "op8_source_mixing": source_mixing,
    "op9_lm_scoring": lm_scoring,
    "op10_warc": warc_archives,
    "op11_conversation_repair": conversation_repair,
    "op12_centroid_clustering": centroid_clustering,
    "op13_byte_bpe": byte_bpe,
}
ORACLE = {name: sql for name, sql in oracles.ORACLE.items() if name in QUERIES}
