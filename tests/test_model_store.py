"""Stored models, concurrent fits, tree arrays and permutation importance."""

from __future__ import annotations

import threading
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from wardlens.ml import concurrent, explain, forecasting, metrics, models, store, trees
from wardlens.operators import contracts

TINY = models.ModelSizes(
    forest_trees=3, forest_depth=3, regression_trees=3, regression_depth=3, boosting_rounds=2, stacking_trees=2,
    stacking_depth=2, stacking_rounds=2, stacking_folds=2,
)


def test_run_all_gives_every_result_and_raises(spark):
    assert concurrent.run_all(spark, {k: lambda k=k: spark.range(k).count() for k in range(12)}, 3) == {k: k for k in range(12)}
    started = []

    def fails():
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        concurrent.run_all(spark, {"a": fails, **{k: lambda k=k: started.append(k) for k in range(50)}}, 1)
    assert len(started) < 50


@pytest.fixture(scope="module")
def shelf(spark, tmp_path_factory):
    return store.ModelStore(spark, str(tmp_path_factory.mktemp("models")))


@pytest.mark.parametrize("candidates", [["boosted_depth3"], ["linear_regression", "stacking_regressor"], ["stacking_regressor"]])
def test_a_stored_model_predicts_the_same(data, shelf, candidates):
    trained = models.train_regression(data.features, "revenue_scenario", TINY, candidates)
    found = shelf.publish("-".join(candidates), trained).read()

    def predicted(model):
        return model.transform(data.features).select("admission_id", "prediction").toPandas().sort_values("admission_id")["prediction"]

    assert np.allclose(predicted(found.model), predicted(trained.model))
    assert found.lineage == trained.lineage and found.features == trained.features
    assert sorted(map(tuple, found.metrics.collect())) == sorted(map(tuple, trained.metrics.collect()))
    assert models.model_signature(found.model) == trained.lineage["model_hash"]


def test_a_vote_is_stored_with_its_members(data, shelf):
    trained = models.train_readmission(data.features, TINY, ["logistic", "random_forest", "boosted_depth3"])
    vote = models.Voting([models._fit_classifiers([n], _prepared(data), TINY)[n] for n in ("logistic", "random_forest")])
    found = shelf.publish("vote", models.TrainedModel("readmission", vote, trained.metrics, trained.lineage, trained.features)).read()
    assert isinstance(found.model, models.Voting) and len(found.model.members) == 2
    assert models.model_signature(found.model) == models.model_signature(vote)


def _prepared(data):
    base = models.with_balanced_weights(models._labelled(data.features, "readmitted_30d"))
    return models.Prepared(models.READMISSION_FEATURES, base, data.features.count(), ["admission_id", "label", "weight"])


def test_one_training_for_threads_that_ask_together(data, shelf):
    trained = models.train_regression(data.features, "waiting_simulation", TINY, ["linear_regression"])
    runs, found = [], []

    def train():
        runs.append(1)
        return trained

    threads = [threading.Thread(target=lambda: found.append(shelf.obtain("together", train).artifact)) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(runs) == 1 and len(set(found)) == 1 and len(found) == 4
    other = store.ModelStore(shelf.spark, shelf.root)
    assert other.obtain("together", train).artifact == found[0] and len(runs) == 1


def test_the_first_of_two_attempts_is_published(data, shelf):
    trained = models.train_regression(data.features, "waiting_simulation", TINY, ["linear_regression"])
    first, second = (shelf.publish("twice", trained) for _ in range(2))
    assert first.artifact == second.artifact
    assert len(list(Path(shelf.root, "twice").glob("attempt-*"))) == 1
    assert not first.damage()


@pytest.mark.parametrize("how", ["changed", "lost", "added"])
def test_damage_fails_the_contract(data, shelf, how):
    stored = shelf.publish(how, models.train_regression(data.features, "waiting_simulation", TINY, ["linear_regression"]))
    assert statuses(data, stored) == {"model:waiting_simulation": "passed"}
    file = next(Path(stored.artifact).glob("model/stages/*/data/*.parquet"))
    if how == "changed":
        content = bytearray(file.read_bytes())
        content[len(content) // 2] ^= 1
        file.write_bytes(content)
    elif how == "lost":
        file.unlink()
    else:
        file.with_name("part-99999.parquet").write_bytes(b"more")
    assert len(stored.damage()) == 1
    assert statuses(data, stored) == {"model:waiting_simulation": "failed"}


def statuses(data, stored):
    rows = contracts.check_model_lineage(models.registry(data.spark, [stored.lineage()])).collect()
    return {r["check"]: r["status"] for r in rows}


def test_explanations_are_bound_to_their_model(data, shelf):
    trained = models.train_regression(data.features, "waiting_simulation", TINY, ["boosted_depth3"])
    stored = shelf.publish("explained", trained)
    made = []

    def report(t):
        made.append(1)
        return explain.global_importance(t.model, data.features, t.features)

    assert stored.explanation() is None
    first = stored.explain(report).collect()
    assert stored.explain(report).collect() == first and len(made) == 1

    def status(registry_of, explained_of):
        explanation = explained_of.explanation()
        frame = data.spark.createDataFrame(
            [("waiting_simulation", explanation["model_hash"], explanation["report_intact"])],
            "task string, model_hash string, report_intact boolean",
        )
        rows = contracts.check_model_lineage(models.registry(data.spark, [registry_of.lineage()]), frame).collect()
        return {r["check"]: r["status"] for r in rows}["explanation:waiting_simulation"]

    assert status(stored, stored) == "passed"
    other = shelf.publish("other", models.train_regression(data.features, "waiting_simulation", TINY, ["linear_regression"]))
    assert status(other, stored) == "failed"
    report_file = next(Path(stored.folder).glob("explanation-*/*.parquet"))
    report_file.write_bytes(report_file.read_bytes()[:-1] + b"!")
    assert status(stored, stored) == "failed"


def test_key_depends_on_everything_a_model_is_made_from():
    keys = {
        store.model_key(t, f, s, c)
        for t in ("a", "b") for f in ("1", "2") for s in (TINY, models.ModelSizes()) for c in (("x",), ("x", "y"))
    }
    assert len(keys) == 16


ESTIMATORS = {
    "boosted": lambda: GBTRegressor(maxIter=5, maxDepth=3, stepSize=0.2, seed=1),
    "forest": lambda: RandomForestRegressor(numTrees=4, maxDepth=5, seed=1),
    "boosted classes": lambda: GBTClassifier(maxIter=4, maxDepth=3, seed=1),
    "forest of classes": lambda: RandomForestClassifier(numTrees=5, maxDepth=4, seed=1),
}


@pytest.mark.parametrize("name", ESTIMATORS)
def test_flat_trees_predict_and_add_up(spark, data, name):
    estimator = ESTIMATORS[name]()
    target = "readmitted_30d" if hasattr(estimator, "probabilityCol") else "revenue_per_patient"
    base = models._labelled(data.features, target)
    fitted = Pipeline(stages=[*models.preprocessor(models.REVENUE_FEATURES, base.count()), estimator]).fit(base)
    flat = trees.flat_trees(spark, fitted.stages[-1])
    score = vector_to_array("probability")[1] if hasattr(estimator, "probabilityCol") else F.col("prediction")
    scored = fitted.transform(base).select(vector_to_array("features").alias("x"), score.alias("y")).toPandas()
    rows = np.array(scored["x"].tolist())
    values = flat.predict(rows)
    expected = 1 / (1 + np.exp(-2 * values)) if isinstance(estimator, GBTClassifier) else values
    assert np.allclose(expected, scored["y"])
    parts = flat.contributions(rows)
    assert np.allclose(parts.sum(axis=1) + flat.base, values)
    assert (parts != 0).any()
    shown = explain.with_contributions(fitted, base, models.REVENUE_FEATURES).select("logit").toPandas()["logit"]
    assert np.allclose(np.sort(shown), np.sort(values))
    drivers = explain.linear_contributions(fitted, base, models.REVENUE_FEATURES)
    assert drivers.where("driver_rank > 4").count() == 0 and drivers.count() > 0
    table = explain.global_importance(fitted, base, models.REVENUE_FEATURES).toPandas()
    means = np.abs(parts).mean(axis=0)
    names = models.feature_names(fitted, models.REVENUE_FEATURES)
    assert np.allclose(table.set_index("feature").loc[names, "importance"], means)


def test_area_per_group_equals_the_area_of_each_group(spark):
    rng = np.random.default_rng(3)
    rows = [(g, int(rng.integers(0, 2)), float(rng.integers(0, 6)) / 5) for g in "abc" for _ in range(60)] + [("d", 1, 0.5)]
    df = spark.createDataFrame(rows, "g string, label int, probability double")
    found = {r["g"]: r["roc_auc"] for r in metrics.roc_auc_by(df, "g").collect()}
    for g in "abc":
        assert found[g] == pytest.approx(metrics.roc_auc(df.where(F.col("g") == g)).first()[0])
    assert found["d"] is None


def test_permuting_a_useless_column_costs_nothing(spark):
    rows = [(k, float(k % 7), float(k * 37 % 11), "x" if k % 2 else "y", 3.0 * (k % 7)) for k in range(400)]
    df = spark.createDataFrame(rows, "admission_id long, los_days double, hba1c double, season string, y double")
    features = ("los_days", "hba1c", "season")
    stages = models.preprocessor(features, df.count())
    fitted = Pipeline(stages=[*stages, LinearRegression(regParam=1e-9)]).fit(models._labelled(df, "y"))
    found = explain.permutation_importance(fitted, df, features, "y").toPandas().set_index("feature")
    assert found.loc["los_days", "importance"] > 3 and abs(found.loc["hba1c", "importance"]) < 1e-6
    assert abs(found.loc["season", "importance"]) < 1e-6 and (found["baseline"] < 1e-6).all()


def test_each_variant_permutes_one_column(spark):
    rows = [(k, k * 10, f"s{k % 5}") for k in range(50)]
    df = spark.createDataFrame(rows, "admission_id long, a long, b string")
    both = explain.permuted_variants(df, "admission_id", ["a", "b"]).toPandas()
    assert both.groupby("permuted").size().to_dict() == {"": 50, "a": 50, "b": 50}
    plain = {k: (a, b) for k, a, b in rows}
    for name, group in both.groupby("permuted"):
        assert sorted(group["a"]) == sorted(a for _, a, _ in rows) and sorted(group["b"]) == sorted(b for _, _, b in rows)
        moved = [(a != plain[k][0], b != plain[k][1]) for k, a, b in zip(group["admission_id"], group["a"], group["b"])]
        assert all(m[0] for m in moved) if name == "a" else not any(m[0] for m in moved)
        if name != "b":
            assert not any(m[1] for m in moved)
    one = explain.permuted_variants(df.limit(1), "admission_id", ["a", "b"])
    assert one.count() == 3 and explain.permuted_variants(df.limit(0), "admission_id", ["a"]).count() == 0


def test_importance_of_a_stacked_model(data):
    trained = models.train_regression(data.features, "revenue_scenario", TINY, ["stacking_regressor"])
    table = explain.global_importance(trained.model, data.features, trained.features, target="revenue_per_patient")
    assert {r["feature"] for r in table.collect()} == set(trained.features)
    with pytest.raises(TypeError):
        explain.with_contributions(trained.model, data.features, trained.features)


def test_tree_forecast_feeds_itself(data):
    daily = forecasting.census_by(data.features, "ward_type")
    fitted = forecasting.fit_occupancy(forecasting.occupancy_features(daily), forecasting.BOOSTED, TINY)
    found = forecasting.forecast_recursive(daily, fitted, horizon=4).toPandas()
    flat = trees.flat_trees(data.spark, fitted)
    assert len(found) == 4 * found["series"].nunique() and found["series"].nunique() == 4
    for series, group in daily.toPandas().groupby("series"):
        beds = list(group.sort_values("date")["occupied_beds"].astype(float))
        for _, row in found[found["series"] == series].sort_values("forecast_date").iterrows():
            day = pd.Timestamp(row["forecast_date"])
            x = [day.dayofweek, day.month, float(day.dayofweek >= 5), beds[-1], beds[-7], np.mean(beds[-7:])]
            beds.append(max(float(flat.predict(np.array([x]))[0]), 0.0))
            assert row["forecast_occupied_beds"] == pytest.approx(beds[-1])


def test_one_step_equals_the_fitted_model(data):
    """The arrays give on known days what the model's own transformation gives."""
    model_data = forecasting.occupancy_features(data.census)
    fitted = forecasting.fit_occupancy(model_data, forecasting.BOOSTED, TINY)
    rows = fitted.transform(forecasting._assembled(model_data)).select(*forecasting.OCCUPANCY_FEATURES, "prediction").toPandas()
    flat = trees.flat_trees(data.spark, fitted)
    assert np.allclose(flat.predict(rows[list(forecasting.OCCUPANCY_FEATURES)].to_numpy(float)), rows["prediction"])


def test_candidates_of_the_bed_forecast_compete(data):
    trained = forecasting.train_occupancy(data.census, TINY)
    table = {r["model"]: r["mae"] for r in trained.metrics.collect()}
    assert set(table) == {forecasting.LINEAR, forecasting.BOOSTED, forecasting.AVERAGE}
    learned = {n: v for n, v in table.items() if n != forecasting.AVERAGE}
    assert trained.lineage["selected_model"] == min(learned, key=learned.get)


def test_fingerprint_algebra(spark):
    rows = [(k, f"v{k % 3}", k / 7, "a" if k % 2 else None) for k in range(40)] + [(1, "v1", 1 / 7, "a")]
    df = spark.createDataFrame(rows, "k long, part string, x double, t string")
    whole = contracts.fingerprint_state(df)
    parts = contracts.fingerprint_state(df.repartition(5), "part")
    assert contracts.merged_state(parts.drop("part")).collect() == whole.collect()
    appended = contracts.merged_state(
        contracts.fingerprint_state(df.where("k < 20")).unionByName(contracts.fingerprint_state(df.where("k >= 20")))
    )
    assert appended.collect() == whole.collect()
    less = contracts.merged_state(whole, removed=contracts.fingerprint_state(df.where("k >= 20")))
    assert less.collect() == contracts.fingerprint_state(df.where("k < 20")).collect()
    changed = df.withColumn("t", F.when(F.col("k") == 4, "b").otherwise(F.col("t"))).where("part <> 'v2'")
    found = contracts.changed_parts(parts, contracts.fingerprint_state(changed, "part"), "part").collect()
    assert {r["part"] for r in found} == {"v1", "v2"}
    swapped = spark.createDataFrame([(1, None), (2, "n")], "a long, b string")
    other = spark.createDataFrame([(1, "n"), (2, None)], "a long, b string")
    assert contracts.fingerprint_state(swapped).collect() != contracts.fingerprint_state(other).collect()
    assert contracts.dataset_fingerprint(df.where("false")).first()["rows"] == 0
