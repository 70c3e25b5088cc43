"""Reproducible splits and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.config import CONFIG
from wardlens.functions.columns import stable_int
from wardlens.functions.scale import order_statistics

BUCKETS = 10_000


def _bucket(column: str, seed: int, modulo: int) -> Column:
    return stable_int(F.concat(F.lit(f"{seed}:"), F.col(column).cast("string")), modulo)


def with_group_side(df: DataFrame, group: str, test: float = 0.2, seed: int = CONFIG.random_state) -> DataFrame:
    """Mark every row as train or test by a hash of its group: all rows of a group fall on one side."""
    side = F.when(_bucket(group, seed, BUCKETS) < int(test * BUCKETS), "test").otherwise("train")
    return df.withColumn("side", side)


def group_split(
    df: DataFrame, group: str, test: float = 0.2, seed: int = CONFIG.random_state
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train rows, test rows and the audit row."""
    sided = with_group_side(df, group, test, seed)
    return (
        sided.where("side = 'train'").drop("side"), sided.where("side = 'test'").drop("side"), split_audit(sided, group),
    )


def split_audit(sided: DataFrame, group: str) -> DataFrame:
    """Rows and groups per side, and groups seen on both (from one count per group)."""
    per_group = sided.groupBy(group).agg(
        F.count_if(F.col("side") == "train").alias("train"), F.count_if(F.col("side") == "test").alias("test")
    )
    return per_group.agg(
        F.lit(f"hash_bucket({group})").alias("split_strategy"),
        F.sum("train").alias("train_rows"),
        F.sum("test").alias("test_rows"),
        F.count_if(F.col("train") > 0).alias("train_patients"),
        F.count_if(F.col("test") > 0).alias("test_patients"),
        F.count_if((F.col("train") > 0) & (F.col("test") > 0)).alias("patient_overlap"),
    )


def chronological_split(df: DataFrame, order: list[str], share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """First ``share`` of the rows in ``order`` and the rest. Only the row at the cut reaches the driver."""
    keep = int(df.count() * share)
    if keep == 0:
        return df.limit(0), df
    cut = order_statistics(df, order, [keep - 1], "chronological")[keep - 1]
    types = dict(df.dtypes)
    edge = F.struct(*[F.lit(cut[c]).cast(types[c]).alias(c) for c in order])
    before = F.struct(*order) <= edge
    return df.where(before), df.where(~before)


def sample_rows(df: DataFrame, key: str, rows: int | None = None, seed: int = CONFIG.random_state) -> DataFrame:
    """Repeatable sample: the rows with the smallest hash of their key. Without a size all rows are kept."""
    if rows is None:
        return df
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(rows)
