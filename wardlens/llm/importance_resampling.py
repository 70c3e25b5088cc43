"""Quality classification by importance resampling over hashed n-grams.

Two generative models are counted over hashed word unigrams and bigrams: the target's, from documents labelled good and not
toxic (a bounded, hash-drawn sample of ``TARGET_ROWS`` labels), and the raw text's, from all documents. A document's importance is
the ratio of the two models: the mean log ratio of its n-grams, times ``EFFECTIVE_LENGTH``, so that long documents do not
outweigh all others. Adding Gumbel noise drawn by md5 of the id and taking the largest keys samples without
replacement in proportion to the importance. The threshold is the exact k-th key, found by range partitioning, and the sample is a
filter by it: nothing is ranked in one task. Models are 10,000 buckets each, whatever the corpus.

Cases: null and empty texts, and texts without a word, have no n-gram: their weight is null and they are never selected nor counted for k;
without good labels all weights are equal; repeated rows are separate documents with equal keys, resolved by row; documents
without id draw the noise of an empty id; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scale import materialize, order_statistics
from wardlens.llm.exchange import PACKED_DDL, added_up, packed_rows, task_group, text_batches
from wardlens.llm.hashing import U64, ascii_words, sequence_hashes, word_hashes
from wardlens.llm.mixing import uniform
from wardlens.llm.shipping import ship_package

BUCKETS = 10_000
SLICES = 50
TARGET_ROWS = 20_000
EFFECTIVE_LENGTH = 200.0
FRACTION = 0.9
SEED = "resample"


def ngram_buckets(text: str | None) -> np.ndarray:
    """Bucket of every word and every pair of consecutive words."""
    words = word_hashes(ascii_words(text))
    return (np.concatenate([words, sequence_hashes(words, 2)]) % U64(BUCKETS)).astype(np.int64)


def _count(shared):
    """Bucket totals of a task: ``SLICES`` rows of target and raw counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, totals = shared.value, np.zeros((2, BUCKETS), np.int64)
        for batch in text_batches(batches):
            for i, text in zip(batch.column("_id").to_pylist(), batch.column("_text")):
                counts = np.bincount(ngram_buckets(text.as_py()), minlength=BUCKETS)
                totals[1] += counts
                if i in target:
                    totals[0] += counts
        parts = np.split(totals, SLICES, axis=1)
        yield from packed_rows((task_group(), s, part.tobytes()) for s, part in enumerate(parts)).to_batches()

    return run


def _add(table: pa.Table) -> pa.Table:
    blobs = table.column("data").to_pylist()
    total = np.sum([np.frombuffer(b, np.int64) for b in blobs], axis=0)
    return packed_rows([(0, table.column("bucket")[0].as_py(), total.tobytes())])


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket the log of target over raw probability, both with one count added."""
    if not target.sum():
        return np.zeros(len(raw))
    return np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))


def _weigh(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = shared.value
        for batch in text_batches(batches):
            sizes, means = [], []
            for text in batch.column("_text"):
                buckets = ngram_buckets(text.as_py())
                sizes.append(len(buckets))
                means.append(float(ratios[buckets].mean()) if len(buckets) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(sizes, pa.int64()), pa.array(means, pa.float64())],
                names=["doc_id", "n_grams", "mean_ratio"],
            )

    return run


def importance_weights(docs: DataFrame, labels: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """doc_id, n_grams and mean_ratio per document, with models learned from ``docs`` and ``labels``."""
    spark = docs.sparkSession
    ship_package(spark)
    good = labels.where((F.col("`quality`") == 1) & ~F.coalesce(F.col("`toxic`") == 1, F.lit(False)))
    drawn = (
        good.select(F.col("`doc_id`").cast("long").alias("i")).where("i is not null").distinct()
        .orderBy(F.xxhash64(F.lit(SEED), "i"), "i").limit(target_rows)
    )
    target = spark.sparkContext.broadcast(frozenset(r["i"] for r in drawn.collect()))
    read = docs.select(F.col("`doc_id`").cast("long").alias("_id"), F.col("`text`").cast("string").alias("_text"))
    totals = np.zeros((SLICES, 2, BUCKETS // SLICES), np.int64)
    for row in added_up(read.mapInArrow(_count(target), PACKED_DDL), _add).collect():
        totals[row["bucket"]] = np.frombuffer(row["data"], np.int64).reshape(2, -1)
    counts = totals.transpose(1, 0, 2).reshape(2, BUCKETS)
    ratios = spark.sparkContext.broadcast(log_ratios(counts[0], counts[1]))
    return read.mapInArrow(_weigh(ratios), "doc_id long, n_grams long, mean_ratio double")


def resample(docs: DataFrame, labels: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Per document: doc_id, n_grams, log_weight, noisy key and whether the sample of ``fraction`` holds it (kept)."""
    weights = importance_weights(docs, labels)
    number = uniform(F.concat_ws("|", F.lit(SEED), F.col("doc_id").cast("string")))
    keyed = weights.select(
        "doc_id", "n_grams", (F.col("mean_ratio") * EFFECTIVE_LENGTH).alias("log_weight"),
        (F.col("mean_ratio") * EFFECTIVE_LENGTH - F.log(-F.log(number))).alias("key"),
    )
    keyed = materialize(keyed.withColumn("row", F.monotonically_increasing_id()), "keys")
    ranked = keyed.where(F.col("key").isNotNull()).select((-F.col("key")).alias("minus_key"), "row")
    size = round(fraction * ranked.count())
    last = order_statistics(ranked, ["minus_key", "row"], [size - 1], "keys").get(size - 1) if size else None
    if last is None:
        kept = F.lit(False)
    else:
        minus = -F.col("key")
        kept = (minus < last["minus_key"]) | ((minus == last["minus_key"]) & (F.col("row") <= last["row"]))
    return keyed.select("doc_id", "n_grams", "log_weight", "key", F.coalesce(kept, F.lit(False)).alias("kept"))
