"""A training corpus from ``documents``: five stages, each over all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import decontaminate, mixing, quality_rules, simhash, token_binary
from starmart.llm.common import table
from starmart.session import new_folder

TOKENIZER = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_first(docs, keep_unnamed=False)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated with the benchmark, as they are."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes, which may be none."""
    return mixing.take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document copy its place and size in the binary token files, as read back from them."""
    target = new_folder(spark, "pipeline-tokens")
    token_binary.write_tokens(docs, public_tokenizers.path(TOKENIZER), target)
    return token_binary.read_documents(spark, target).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_duplicates),
          ("benchmark_decontamination", decontamination), ("mixing", mix), ("token_binary", tokens)]

ORACLE_SQL = None  # votes, fingerprints and tokens have no SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        target = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(target)
        docs = spark.read.parquet(target)
    return docs
