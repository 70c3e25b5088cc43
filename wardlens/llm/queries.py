"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm import (
    arc_to_warc,
    decontamination,
    exact_topk,
    importance_resampling,
    language_id,
    mixing,
    ngram_join,
    packing,
    quality_rules,
    spelling_variants,
    suffix_dedup,
    token_alignment,
    token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op5_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_to_warc.pages_through_archives(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "source", "copy", "text", "shuffle_key")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.token_alignment(table(spark, sf_dir, "documents"), first, second)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_importance_resampling": op2_importance_resampling,
    "op3_packing": op3_packing,
    "op4_ngram_join": op4_ngram_join,
    "op5_arc_to_warc": op5_arc_to_warc,
    "op6_quality_rules": op6_quality_rules,
    "op7_exact_topk": op7_exact_topk,
    "op8_source_mix": op8_source_mix,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_alignment": op12_token_alignment,
    "op13_decontamination": op13_decontamination,
}
