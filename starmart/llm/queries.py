"""The registered queries of the operators, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (decontaminate, license_scan, line_dedup, mixing, packing, pitman_yor, quality_rules,
                          simhash, spelling, token_binary, toxicity, url_filter, whitening)
from starmart.llm.common import fold_crc, table
from starmart.llm.oracles import ORACLES  # noqa: F401
from starmart.session import new_folder

TOKENIZER = "byte_bpe_50k.json"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped",
                        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    of = lambda fixed: F.filter("places", lambda p: p["fixed"]) if fixed else F.col("places")
    names = lambda places: F.array_join(F.array_sort(F.array_distinct(
        F.transform(places, lambda p: p["label"]))), ",")
    starts = F.transform(of(True), lambda p: p["start"])
    return found.select(
        "doc_id", "n_words", F.size(of(True)).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names(of(True)).alias("base_labels"), names(of(False)).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"))


def op3_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_folder(spark, "tokens")
    token_binary.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), target)
    return token_binary.read_documents(spark, target).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = (fold_crc("doc_id", 7) == 2).alias("held_out")
    return pitman_yor.score_documents(table(spark, sf_dir, "documents"), held_out)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold_crc("doc_id", 3) == 1
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.scores(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    labelled = url_filter.labels_of(pages, table(spark, sf_dir, "labels"))
    return url_filter.judge(pages, labelled).select("page_id", "host", "path", "rule", "verdict")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", *[F.col("found")[name].alias(name) for name in quality_rules.SIGNALS[:5]],
        "base_failed", "kept", "quality")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_line_dedup, op2_license_scan, op3_token_binary, op4_decontaminate, op5_pitman_yor, op6_toxicity,
        op7_url_filter,
        op8_quality_rules, op9_simhash, op10_mix, op11_best_fit_packing, op12_whitening, op13_spelling_variants)}


