from __future__ import annotations

import edge
import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from wardlens.llm import importance_resampling as resampling


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def fixture(spark):
    return tuple(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))


def test_weights_equal_a_direct_count(fixture):
    docs, marks = fixture
    good = {r.doc_id for r in marks.collect() if r.quality == 1 and r.toxic == 0}
    target, raw = np.zeros(resampling.BUCKETS), np.zeros(resampling.BUCKETS)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for i, text in texts.items():
        counts = np.bincount(resampling.ngram_buckets(text), minlength=resampling.BUCKETS)
        raw += counts
        target += counts * (i in good)
    ratios = resampling.log_ratios(target, raw)
    for r in resampling.importance_weights(docs, marks).collect():
        buckets = resampling.ngram_buckets(texts[r.doc_id])
        assert r.n_grams == len(buckets)
        assert r.mean_ratio == pytest.approx(ratios[buckets].mean())


@pytest.mark.parametrize("fraction", [0.0, 0.3, 0.9, 1.0])
def test_the_largest_keys_are_kept(fixture, fraction):
    rows = [r for r in resampling.resample(*fixture, fraction).collect() if r.n_grams]
    keys = sorted((r.key for r in rows), reverse=True)
    kept = sorted((r.key for r in rows if r.kept), reverse=True)
    assert kept == keys[: round(fraction * len(keys))]


def test_good_texts_are_preferred(spark):
    words = ["alpha", "beta", "gamma", "delta"]
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.when(
            F.col("id") % 5 == 0, F.concat(F.lit("junk"), (i % 3).cast("string"))
        ).otherwise(F.element_at(F.array(*map(F.lit, words)), ((i * F.col("id")) % 4 + 1).cast("int"))))).alias("text"),
    )
    marks = docs.where("doc_id % 2 = 0").select("doc_id", F.when(F.col("doc_id") % 5 == 0, 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic"))
    kept = [r.doc_id for r in resampling.resample(docs, marks, 0.8).collect() if r.kept]
    assert len(kept) == 320 and all(i % 5 for i in kept)


def test_edges(spark):
    docs = edge.documents(spark, repeat=True, null_id=True)
    marks = labels(spark, [(1, 1, None), (None, 1, 0), (106, 1, 0), (113, 1, 1), (120, None, 0), (106, 1, 0)])
    out = resampling.resample(docs, marks).collect()
    assert len(out) == docs.count()
    assert all((r.key is None) == (r.n_grams == 0) and (r.n_grams or not r.kept) for r in out)
    with_words = sum(r.n_grams > 0 for r in out)
    assert sum(r.kept for r in out) == round(0.9 * with_words)
    assert resampling.resample(edge.empty(spark), marks).count() == 0
    equal = resampling.resample(docs, labels(spark, [])).collect()
    assert {r.log_weight for r in equal} == {0.0, None}
