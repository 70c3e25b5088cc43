"""A training-data pipeline over ``documents``: each stage is written as Parquet and read by the next one.

Language identification (documents whose language cannot be told go), n-gram Jaccard join (one document of each
group stays), suffix dedup (repeated bytes go, and documents that lose all of theirs), mixing of the sources to
equal weights, best-fit packing. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardlens.functions.scale import materialize
from wardlens.llm import language_id, mixing, ngram_join, packing, suffix_dedup

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.with_known_language(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_per_component(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_languages),
    ("ngram_join", join_near_duplicates),
    ("suffix_dedup", remove_repeats),
    ("source_mix", mix_sources),
    ("packing", pack),
]
ORACLE_SQL = None  # learned, verified and packed by methods that SQL cannot express; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
