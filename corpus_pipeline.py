"""Corpus pipeline over ``documents``: quality rules, language, near-duplicates,
mixture, packing.

Each stage works on all rows that the one before kept and returns the columns
of ``documents``; the last one returns the packed pieces (a document that the
mixture takes several times has its pieces as often).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bomspark.llm import langid, mixing, packing, quality, simhash
from bomspark.llm.common import stored
from bomspark.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base checks and every rule of the table."""
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language with a posterior of at least one half."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_per_group(docs, shingle=3, max_bits=2)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("language ID", language_id),
          ("SimHash near-dedup", near_duplicates), ("mixing to target weights", mixture),
          ("best-fit packing", pack)]

#: The language model and the packing are not SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
