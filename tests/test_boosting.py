"""Boosted trees counted in blocks against MLlib's on the same rows."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from wardlens.ml import boosting, models


def made_rows(spark, rows: int, tasks: int):
    mixed = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n))
    return spark.range(0, rows, 1, tasks).select(
        F.col("id").alias("admission_id"), mixed(1, 9).cast("double").alias("charlson_index"), mixed(2, 40).alias("previous_admissions"),
        (mixed(3, 100_000) / 7).alias("department_load"), mixed(4, 2).cast("int").alias("is_weekend_admission"),
        F.concat(F.lit("t"), mixed(5, 3)).alias("admit_type"), F.concat(F.lit("w"), mixed(6, 4)).alias("ward_type"),
        F.concat(F.lit("s"), mixed(7, 4)).alias("season"),
    ).select(
        "*", (F.col("charlson_index") * 3 + F.sqrt("department_load") + F.when(F.col("ward_type") == "w1", 20).otherwise(0)).alias("minutes"),
    )


@pytest.fixture(scope="module")
def prepared(spark):
    rows = made_rows(spark, 1_500, 1)
    labelled = rows.withColumn("label", F.col("minutes")).withColumn("late", (F.col("minutes") > 80).cast("double"))
    return models.Prepared(models.WAITING_FEATURES, labelled, 1_500, ["admission_id", "label", "late"])


def text(model) -> str:
    return re.sub(r"uid=\w+", "", model.toDebugString)


def test_draws_are_those_of_spark(spark):
    draws = boosting.Draws(45)
    found = np.concatenate([draws.take(n) for n in (3, 0, 2_500, 1)])
    theirs = spark._jvm.org.apache.spark.util.random.XORShiftRandom(45)
    assert found.tolist() == [theirs.nextDouble() for _ in range(2_504)]


def test_estimators_of_common_passes_are_those_of_mllib(prepared):
    part = F.col("admission_id") % 5 != 2
    work = {
        "deep": (GBTRegressor(maxIter=3, maxDepth=5, stepSize=0.08, seed=42), None),
        "part": (GBTRegressor(maxIter=4, maxDepth=3, seed=42), part),
        "class": (GBTClassifier(labelCol="late", maxIter=3, maxDepth=3, subsamplingRate=0.9, seed=42), None),
        "few": (GBTRegressor(maxIter=2, maxDepth=4, seed=1, minInstancesPerNode=40, subsamplingRate=0.5), part),
    }
    regressions = {n: w for n, w in work.items() if n != "class"}
    found = boosting.fit_boosted(regressions, prepared.data) | boosting.fit_boosted({"class": work["class"]}, prepared.data)
    for name, (estimator, where) in work.items():
        theirs = estimator.fit(prepared.data if where is None else prepared.data.where(where))
        assert text(found[name]) == text(theirs)
        assert found[name].treeWeights == theirs.treeWeights and found[name].featureImportances == theirs.featureImportances
        assert found[name].explainParams() == theirs.explainParams()


def test_many_rows_are_counted_together(prepared, monkeypatch):
    calls = []
    monkeypatch.setattr(models, "COUNTED_ROWS", 1)
    monkeypatch.setattr(models, "fit_boosted", lambda work, data: calls.append(list(work)) or boosting.fit_boosted(work, data))
    sizes = models.ModelSizes(
        regression_trees=2, regression_depth=2, boosting_rounds=2, stacking_trees=2, stacking_depth=2, stacking_rounds=2, stacking_folds=2
    )
    names = ["linear_regression", "random_forest", "gradient_boosting", "boosted_depth5", "stacking_regressor"]
    found = models._fit_regressors(names, prepared, sizes)
    assert [sorted(map(str, c)) for c in calls] == [["('fold', 0, 1)", "('fold', 1, 1)", "boosted_depth5", "gradient_boosting"]]
    monkeypatch.setattr(models, "COUNTED_ROWS", 10**9)
    theirs = models._fit_regressors(names, prepared, sizes)
    assert len(calls) == 1
    assert {n: models.model_signature(m) for n, m in found.items()} == {n: models.model_signature(m) for n, m in theirs.items()}


def test_no_split_and_refused_labels(spark, prepared):
    estimator = GBTRegressor(maxIter=2, maxDepth=2, seed=42)
    same = prepared.data.withColumn("label", F.lit(4.0))
    assert text(boosting.fit_boosted({"a": (estimator, None)}, same)["a"]) == text(estimator.fit(same))
    with pytest.raises(Exception, match="Labels MUST"):
        boosting.fit_boosted({"a": (estimator, None)}, prepared.data.withColumn("label", F.lit(None).cast("double")))
    with pytest.raises(ValueError, match="same features"):
        boosting.fit_boosted({"a": (estimator, None), "b": (GBTRegressor(labelCol="late"), None)}, prepared.data)
    assert not boosting.is_counted(GBTRegressor(lossType="absolute")) and boosting.is_counted(estimator)
