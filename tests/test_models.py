from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardlens.ml import explain, forecasting, metrics, models, splits

TINY = models.ModelSizes(
    forest_trees=3, forest_depth=3, regression_trees=3, regression_depth=3, boosting_rounds=2, stacking_trees=2,
    stacking_depth=2, stacking_rounds=2, stacking_folds=2,
)


@pytest.fixture(scope="module")
def logistic(data):
    return data.readmission_logistic


def test_scaling_uses_population_deviation(spark, data):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = data.features.count()
    fitted = Pipeline(stages=models.preprocessor(models.WAITING_FEATURES, rows)).fit(data.features)
    first = fitted.transform(data.features).select(vector_to_array("features")[0].alias("z"), "charlson_index").toPandas()
    values = first["charlson_index"]
    assert np.allclose(first["z"], (values - values.mean()) / values.std(ddof=0))


def test_unseen_category_is_all_zero(data):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    fitted = Pipeline(stages=models.preprocessor(models.WAITING_FEATURES, 10)).fit(data.features)
    strange = data.features.limit(1).withColumn("ward_type", F.lit("Attic"))
    names = models.feature_names(fitted, models.WAITING_FEATURES)
    values = fitted.transform(strange).select(vector_to_array("features")).first()[0]
    wards = [v for n, v in zip(names, values) if n.startswith("categorical__ward_type_")]
    assert len(names) == len(values) and len(wards) == 4 and not any(wards)


def test_logit_is_reconstructed(data, logistic):
    rows = explain.with_contributions(logistic.model, data.features, models.READMISSION_FEATURES)
    pdf = models.predict_class(logistic.model, data.features).select("admission_id", "probability").join(
        rows.select("admission_id", "logit"), "admission_id"
    ).toPandas()
    assert np.allclose(1 / (1 + np.exp(-pdf["logit"])), pdf["probability"], atol=1e-9)


def test_drivers_are_the_largest_contributions(data, logistic):
    few = data.features.orderBy("admission_id").limit(20)
    drivers = explain.linear_contributions(logistic.model, few, models.READMISSION_FEATURES).toPandas()
    everything = explain.with_contributions(logistic.model, few, models.READMISSION_FEATURES).select(
        "admission_id", F.explode("contributions").alias("c")
    ).select("admission_id", "c.*").toPandas()
    for key, group in drivers.groupby("admission_id"):
        sizes = everything.loc[everything["admission_id"] == key, "contribution"].abs().nlargest(4)
        assert np.allclose(sorted(group["contribution"].abs()), sorted(sizes))
        assert list(group.sort_values("driver_rank")["contribution"].abs()) == sorted(group["contribution"].abs(), reverse=True)
    assert drivers.loc[drivers["feature"] == "Length of stay", "observed_value"].str.endswith(" days").all()


def test_importance_is_centred(data, logistic):
    table = explain.global_importance(logistic.model, data.features, models.READMISSION_FEATURES).toPandas()
    assert table["importance"].is_monotonic_decreasing and (table["importance"] >= 0).all()
    top = explain.top_positive_driver(logistic.model, data.features, models.READMISSION_FEATURES)
    assert top.count() == data.features.count() and top.where("factor_contribution <= 0").count() == 0


def test_scores_cover_all_admissions(data, logistic):
    scores = explain.score_readmission(logistic.model, data.features).toPandas()
    assert len(scores) == data.features.count()
    bands = pd.cut(scores["probability"], [-1, 0.35 - 1e-12, 0.65 - 1e-12, 2], labels=["LOW RISK", "MONITOR", "HIGH RISK"])
    assert (bands.astype(str) == scores["risk_label"]).all()


def test_candidates_and_voting(data):
    trained = models.train_readmission(data.features, TINY)
    names = {r["model"] for r in trained.metrics.collect()}
    assert names == {"logistic", "random_forest", "boosted_depth3", "boosted_depth5", "voting_classifier"}
    assert trained.lineage["patient_overlap"] == 0 and len(trained.lineage["model_hash"]) == 64
    best = trained.metrics.orderBy(F.desc("roc_auc")).first()
    assert best["model"] == trained.lineage["selected_model"]


def test_regression_with_stacking(data):
    trained = models.train_regression(data.features, "revenue_scenario", TINY, ["linear_regression", "stacking_regressor"])
    assert trained.metrics.count() == 2
    scenario = explain.scenario_scores(trained.model, data.features, "revenue_per_patient", 10).toPandas()
    assert (scenario["predicted"] >= 0).all() and np.allclose(scenario["planned_total"], scenario["predicted"] * 10)
    wards = models.ward_predictions(trained.holdout).toPandas()
    assert len(wards) == 4


def test_split_keeps_patients_together(data):
    train, test, audit = splits.group_split(data.features, "patient_id")
    row = audit.first()
    assert row["patient_overlap"] == 0 and train.count() + test.count() == data.features.count()
    assert 0.1 < row["test_patients"] / (row["test_patients"] + row["train_patients"]) < 0.3


def test_sample_is_repeatable(data):
    a = splits.sample_rows(data.features, "admission_id", 50).select("admission_id")
    b = splits.sample_rows(data.features.repartition(3), "admission_id", 50).select("admission_id")
    assert a.count() == 50 and a.exceptAll(b).count() == 0
    assert splits.sample_rows(data.features, "admission_id").count() == data.features.count()


def test_auc_with_ties_and_zero_division(spark):
    df = spark.createDataFrame([(1, 0.0, 0.5), (0, 0.0, 0.5), (1, 0.0, 0.9), (0, 0.0, 0.1)], "label int, prediction double, probability double")
    row = metrics.classification_metrics(df).first()
    assert row["roc_auc"] == pytest.approx(0.875)
    assert (row["precision"], row["recall"], row["f1"], row["tn"], row["fn"]) == (0.0, 0.0, 0.0, 2, 2)


def test_regression_metrics_by_hand(spark):
    df = spark.createDataFrame([(0.0, 0.5), (2.0, 1.0), (4.0, 4.0)], "label double, prediction double")
    y, p = np.array([0, 2, 4.0]), np.array([0.5, 1, 4])
    row = metrics.regression_metrics(df).first()
    assert row["rmse"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert row["mape"] == pytest.approx(np.mean(np.abs(y - p) / np.maximum(np.abs(y), 1)))
    assert row["r2"] == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_forecast_feeds_itself(data):
    daily = data.census
    model = forecasting.fit_occupancy(forecasting.occupancy_features(daily))
    found = forecasting.forecast_recursive(daily, model, horizon=10).orderBy("forecast_date").toPandas()
    beds = list(daily.orderBy("date").toPandas()["occupied_beds"].astype(float))
    for _, row in found.iterrows():
        day = pd.Timestamp(row["forecast_date"])
        x = [day.dayofweek, day.month, float(day.dayofweek >= 5), beds[-1], beds[-7], np.mean(beds[-7:])]
        beds.append(max(float(np.dot(model.coefficients.toArray(), x) + model.intercept), 0.0))
        assert row["forecast_occupied_beds"] == pytest.approx(beds[-1])
    assert len(found) == 10 and (found["forecast_occupancy_pct"] <= 100).all()


def test_one_series_per_department(data):
    daily = forecasting.census_by(data.features, "department")
    total = daily.groupBy("date").agg(F.sum("occupied_beds").alias("d")).join(
        data.census.select("date", F.col("occupied_beds").alias("h")), "date"
    )
    assert total.where("d <> h").count() == 0


def test_tasks_of_a_fit_stop_at_the_cores(spark, data):
    """Every task of a forest's pass sends statistics of all its nodes, so tasks beyond the cores only add shuffle."""
    assert [models.fit_tasks(n, 12) for n in (0, 1, 100_000, 100_001, 900_000)] == [1, 1, 1, 2, 9]
    assert models.fit_tasks(9_000_000, 12) == 12
    assert models.fit_tasks(54_000_000, 12) == 54
    rows = 90 * models.ROWS_PER_TASK
    spread = models._labelled(data.features, "waiting_time_minutes").repartition(40)
    prepared = models.Prepared(models.WAITING_FEATURES, spread, rows, ["label"])
    assert prepared.data.rdd.getNumPartitions() == max(9, spark.sparkContext.defaultParallelism)
    assert prepared.data.count() == data.features.count()
    prepared.release()
