"""Preprocessing, candidate models and model selection."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Hashable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.config import CONFIG
from wardlens.ml.boosting import fit_boosted, is_counted
from wardlens.ml.concurrent import run_all
from wardlens.ml.metrics import classification_metrics, regression_metrics
from wardlens.ml.splits import _bucket, group_split

# Model inputs per task.
CATEGORICAL = ("admit_type", "ward_type", "season", "hospital_id")
READMISSION_FEATURES = (
    "los_days", "num_procedures", "charlson_index", "hba1c", "creatinine", "haemoglobin", "systolic_bp",
    "previous_admissions", "readmission_history", "disease_severity_score", "lab_abnormality_score",
    "patient_complexity_index", "admit_type", "ward_type", "season",
)
WAITING_FEATURES = (
    "charlson_index", "previous_admissions", "department_load", "is_weekend_admission", "admit_type", "ward_type",
    "season",
)
REVENUE_FEATURES = (
    "los_days", "num_procedures", "charlson_index", "hba1c", "creatinine", "haemoglobin", "systolic_bp",
    "previous_admissions", "disease_severity_score", "lab_abnormality_score", "medicine_count",
    "patient_complexity_index", "admit_type", "ward_type", "season",
)


@dataclass(frozen=True)
class ModelSizes:
    """Ensemble sizes; the defaults are the full ones."""

    forest_trees: int = 90
    forest_depth: int = 10
    regression_trees: int = 80
    regression_depth: int = 12
    boosting_rounds: int = 100
    learning_rate: float = 0.08
    stacking_trees: int = 50
    stacking_depth: int = 10
    stacking_rounds: int = 50
    stacking_folds: int = 5
    seed: int = CONFIG.random_state


def split_features(features: Sequence[str]) -> tuple[list[str], list[str]]:
    return [f for f in features if f not in CATEGORICAL], [f for f in features if f in CATEGORICAL]


def preprocessor(features: Sequence[str], rows: int) -> list:
    """Stages building ``features``: numbers scaled by mean and population deviation, categories one-hot.

    A category unseen in training gets the extra index that the encoder drops, so it becomes all zeros.
    ``rows`` turns the sample deviation of the scaler into the population deviation.
    """
    numeric, categorical = split_features(features)
    correction = math.sqrt(rows / (rows - 1)) if rows > 1 else 1.0
    stages = [
        VectorAssembler(inputCols=numeric, outputCol="numeric_raw", handleInvalid="error"),
        StandardScaler(inputCol="numeric_raw", outputCol="numeric_sample", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="numeric_sample", outputCol="numeric", scalingVec=Vectors.dense([correction] * len(numeric))
        ),
    ]
    if not categorical:
        return [*stages, VectorAssembler(inputCols=["numeric"], outputCol="features")]
    return [
        *stages,
        StringIndexer(
            inputCols=categorical, outputCols=[f"{c}_index" for c in categorical], handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=[f"{c}_index" for c in categorical], outputCols=[f"{c}_onehot" for c in categorical], dropLast=True
        ),
        VectorAssembler(inputCols=["numeric", *[f"{c}_onehot" for c in categorical]], outputCol="features"),
    ]


def standardized(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The numeric features as the models see them, one column each."""
    numeric = split_features(features)[0]
    fitted = Pipeline(stages=preprocessor(features, df.count())).fit(df)
    slots = vector_to_array("features")
    return fitted.transform(df).select("admission_id", *[slots[k].alias(c) for k, c in enumerate(numeric)])


def feature_names(model: PipelineModel, features: Sequence[str]) -> list[str]:
    """Names of the vector slots: ``numeric__x`` and ``categorical__column_value``."""
    numeric, categorical = split_features(features)
    names = [f"numeric__{c}" for c in numeric]
    if categorical:
        indexer = next(s for s in model.stages if s.__class__.__name__ == "StringIndexerModel")
        for column, labels in zip(categorical, indexer.labelsArray):
            names += [f"categorical__{column}_{label}" for label in labels]
    return names


def with_balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Weight ``n / (2 n_class)`` per row, from one small count."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    total, classes = sum(counts.values()), len(counts)
    weight = F.lit(0.0)
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, F.lit(total / (classes * n))).otherwise(weight)
    return df.withColumn("weight", weight)


def _labelled(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn("label", F.col(target).cast("double"))


def _probability() -> F.Column:
    return vector_to_array("probability")[1]


@dataclass
class Voting:
    """Mean probability of several fitted classifiers."""

    members: list[PipelineModel]

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        inner = {"rawPrediction", "probability", "prediction"}
        for k, member in enumerate(self.members):
            scored = member.transform(out)
            added = [c for c in scored.columns if c not in out.columns and c not in inner]
            out = scored.withColumn(f"vote_{k}", _probability()).drop(*added, *inner)
        votes = [F.col(f"vote_{k}") for k in range(len(self.members))]
        score = sum(votes[1:], votes[0]) / len(votes)
        return (
            out.withColumn("probability", score)
            .withColumn("prediction", (F.col("probability") > 0.5).cast("double"))
            .drop(*[f"vote_{k}" for k in range(len(self.members))])
        )


def predict_class(model: PipelineModel | Voting, df: DataFrame) -> DataFrame:
    """Prediction and positive-class probability as plain columns."""
    scored = model.transform(df)
    if isinstance(model, Voting):
        return scored
    return scored.withColumn("probability", _probability())


def classifiers(rows: int, sizes: ModelSizes) -> dict[str, object]:
    """Candidate classifiers. The ridge term matches an unscaled penalty of one half on the summed loss."""
    boosted = dict(maxIter=sizes.boosting_rounds, stepSize=sizes.learning_rate, seed=sizes.seed)
    return {
        "logistic": LogisticRegression(
            maxIter=1000, regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False, weightCol="weight"
        ),
        "random_forest": RandomForestClassifier(
            numTrees=sizes.forest_trees, maxDepth=sizes.forest_depth, seed=sizes.seed, weightCol="weight"
        ),
        "boosted_depth3": GBTClassifier(maxDepth=3, subsamplingRate=0.9, **boosted),
        "boosted_depth5": GBTClassifier(maxDepth=5, **boosted),
    }


@dataclass
class TrainedModel:
    """Selected model refitted on all rows, the metrics of all candidates and the lineage entry."""

    task: str
    model: object
    metrics: DataFrame
    lineage: dict
    features: tuple[str, ...]
    holdout: DataFrame = field(repr=False, default=None)


def _metric_table(spark, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r.values()) for r in rows], list(rows[0]))


def model_signature(model: object) -> str:
    """Hash of the learned parameters: coefficients or the tree text."""
    if isinstance(model, Voting):
        text = "|".join(model_signature(m) for m in model.members)
    elif isinstance(model, Stacked):
        text = "|".join(model_signature(m) for m in (*model.bases, model.final))
    else:
        last = model.stages[-1] if isinstance(model, PipelineModel) else model
        if hasattr(last, "coefficients"):
            text = ",".join(repr(float(v)) for v in (*last.coefficients, last.intercept))
        else:
            text = re.sub(r"uid=\w+", "", last.toDebugString)  # a name drawn per fit is no learned parameter
    return hashlib.sha256(text.encode()).hexdigest()


def _lineage(task: str, best: str, metric: str, value: float, features, audit, origin, tier, use, model, rows) -> dict:
    return {
        "task": task, "selected_model": best, "primary_metric": metric, "primary_metric_value": float(value),
        "features": list(features), "split_strategy": audit["split_strategy"],
        "train_rows": audit["train_rows"], "test_rows": audit["test_rows"],
        "patient_overlap": audit["patient_overlap"], "target_origin": origin, "portfolio_tier": tier,
        "decision_use": use, "model_hash": model_signature(model), "rows": rows,
    }


ROWS_PER_TASK = 100_000  # of vectors in memory; fewer, fuller tasks make the many short passes of boosting cheaper
MOST_ROWS_PER_TASK = 1_000_000
COUNTED_ROWS = 1_000_000  # from here on boosted trees are counted in blocks; MLlib makes the same trees and is faster on fewer rows


def fit_tasks(rows: int, cores: int) -> int:
    """Tasks of every pass of a fit: one per ``ROWS_PER_TASK`` rows up to the cores, beyond them only as rows fill a task.

    Every task of a forest's pass sends the statistics of all open nodes, whether its rows reach them or not, so more tasks than
    cores add shuffle and merging without adding speed.
    """
    return max(1, min(-(-rows // ROWS_PER_TASK), cores), -(-rows // MOST_ROWS_PER_TASK))


class Prepared:
    """Rows with their feature vectors: the preprocessing is fitted once, and only estimators are fitted after it."""

    def __init__(self, features: Sequence[str], train: DataFrame, rows: int, columns: Sequence[str]):
        self.rows = rows
        self.stages = Pipeline(stages=preprocessor(features, rows)).fit(train)
        self.kept = [*columns, "features"]
        tasks = fit_tasks(rows, train.sparkSession.sparkContext.defaultParallelism)
        self.data = self.vectors(train).coalesce(tasks).persist()
        self.data.count()  # once, before several fits ask for it at the same time

    def vectors(self, df: DataFrame) -> DataFrame:
        return self.stages.transform(df).select(*self.kept)

    def fit(self, estimator, where: F.Column | None = None) -> PipelineModel:
        data = self.data if where is None else self.data.where(where)
        return PipelineModel([*self.stages.stages, estimator.fit(data)])

    def fit_all(self, work: Mapping[Hashable, tuple[object, F.Column | None]]) -> dict[Hashable, PipelineModel]:
        """Estimators fitted side by side, each on the rows where its condition holds; boosted trees of many rows in common passes."""
        counted = {n: w for n, w in work.items() if self.rows >= COUNTED_ROWS and is_counted(w[0])}
        pieces: dict = {n: partial(self.fit, *w) for n, w in work.items() if n not in counted}
        if counted:
            pieces = {fit_boosted: partial(fit_boosted, counted, self.data), **pieces}
        fitted = run_all(self.data.sparkSession, pieces)
        boosted = fitted.pop(fit_boosted, {})
        return fitted | {n: PipelineModel([*self.stages.stages, m]) for n, m in boosted.items()}

    def release(self) -> None:
        self.data.unpersist()


def on_vectors(model):
    """The model without its preprocessing, for rows that already carry their vectors."""
    if isinstance(model, Voting):
        return Voting([on_vectors(m) for m in model.members])
    if isinstance(model, Stacked):
        return Stacked([on_vectors(m) for m in model.bases], model.final)
    return PipelineModel(model.stages[-1:])


VOTERS = ("logistic", "random_forest", "boosted_depth3")


def _fit_classifiers(names: Sequence[str], prepared: Prepared, sizes: ModelSizes) -> dict[str, object]:
    """The named candidates, fitted side by side; members of the vote are fitted once."""
    single = list(dict.fromkeys(m for n in names for m in (VOTERS if n == "voting_classifier" else (n,))))
    estimators = classifiers(prepared.rows, sizes)
    slowest_first = sorted(single, key=lambda n: n in ("logistic", "random_forest"))
    fitted = prepared.fit_all({n: (estimators[n], None) for n in slowest_first})
    return {n: Voting([fitted[m] for m in VOTERS]) if n == "voting_classifier" else fitted[n] for n in names}


def train_readmission(feat: DataFrame, sizes: ModelSizes = ModelSizes(), candidates: Sequence[str] | None = None) -> TrainedModel:
    """Fit the candidates on a patient-disjoint split, select by ROC-AUC and refit on all rows."""
    base = _labelled(feat.select("admission_id", "patient_id", *READMISSION_FEATURES, "readmitted_30d"), "readmitted_30d")
    train, test, audit_df = group_split(base, "patient_id", seed=sizes.seed)
    audit = audit_df.first().asDict()
    rows = audit["train_rows"]
    prepared = Prepared(READMISSION_FEATURES, with_balanced_weights(train), rows, ["label", "weight"])
    names = list(candidates or classifiers(rows, sizes))
    if all(m in names for m in VOTERS):
        names.append("voting_classifier")
    fitted = _fit_classifiers(names, prepared, sizes)
    held = prepared.vectors(test.withColumn("weight", F.lit(1.0))).persist()

    def scores(model) -> dict:
        scored = predict_class(on_vectors(model), held).select("label", "prediction", "probability").persist()
        row = classification_metrics(scored).first().asDict()
        scored.unpersist()
        return row

    found = run_all(feat.sparkSession, {n: partial(scores, m) for n, m in fitted.items()})
    table = [{"model": n, **found[n], **audit, "target_origin": "observed"} for n in fitted]
    held.unpersist()
    prepared.release()
    table.sort(key=lambda r: -r["roc_auc"])
    best = table[0]["model"]
    total = rows + audit["test_rows"]
    everything = Prepared(READMISSION_FEATURES, with_balanced_weights(base), total, ["label", "weight"])
    model = _fit_classifiers([best], everything, sizes)[best]
    everything.release()
    lineage = _lineage(
        "readmission", best, "roc_auc", table[0]["roc_auc"], READMISSION_FEATURES, audit, "observed",
        "core_analytical", "screening_research_only", model, total,
    )
    return TrainedModel("readmission", model, _metric_table(feat.sparkSession, table), lineage, READMISSION_FEATURES)


@dataclass
class Stacked:
    """Regressors whose predictions feed a final regressor."""

    bases: list[PipelineModel]
    final: object

    def transform(self, df: DataFrame) -> DataFrame:
        out = _base_predictions(self.bases, df)
        joined = VectorAssembler(inputCols=[f"base_{k}" for k in range(len(self.bases))], outputCol="stacked").transform(out)
        return self.final.transform(joined).drop("stacked", *[f"base_{k}" for k in range(len(self.bases))])


def _base_predictions(bases: Sequence[PipelineModel], df: DataFrame) -> DataFrame:
    out = df
    for k, model in enumerate(bases):
        scored = model.transform(out)
        added = [c for c in scored.columns if c not in out.columns and c != "prediction"]
        out = scored.withColumnRenamed("prediction", f"base_{k}").drop(*added)
    return out


def _stacking_bases(sizes: ModelSizes) -> list[object]:
    return [
        RandomForestRegressor(
            numTrees=sizes.stacking_trees, maxDepth=sizes.stacking_depth, seed=sizes.seed, featureSubsetStrategy="all"
        ),
        GBTRegressor(maxIter=sizes.boosting_rounds, maxDepth=3, stepSize=0.1, seed=sizes.seed),
    ]


def _stacking_folds(sizes: ModelSizes) -> dict[tuple, tuple[object, F.Column]]:
    """Every base and the rows outside of every fold: independent of each other."""
    fold = _bucket("admission_id", sizes.seed, sizes.stacking_folds)
    count = len(_stacking_bases(sizes))
    return {
        ("fold", k, b): (_stacking_bases(sizes)[b], fold != k)
        for b in reversed(range(count)) for k in range(sizes.stacking_folds)
    }


def _stacked(prepared: Prepared, sizes: ModelSizes, bases: list[PipelineModel], folds: Mapping[tuple, PipelineModel]) -> Stacked:
    """The final regressor learns from predictions on rows its bases have not seen."""
    fold = _bucket("admission_id", sizes.seed, sizes.stacking_folds)
    parts = []
    for k in range(sizes.stacking_folds):
        blind = [on_vectors(folds["fold", k, b]) for b in range(len(bases))]
        parts.append(_base_predictions(blind, prepared.data.where(fold == k)).select("base_0", "base_1", "label"))
    unseen = reduce(DataFrame.unionByName, parts)
    unseen = VectorAssembler(inputCols=["base_0", "base_1"], outputCol="stacked").transform(unseen).coalesce(
        prepared.data.rdd.getNumPartitions()
    ).persist()
    final = GBTRegressor(featuresCol="stacked", maxIter=sizes.stacking_rounds, maxDepth=3, stepSize=0.1, seed=sizes.seed).fit(unseen)
    unseen.unpersist()
    return Stacked(bases, final)


def regressors(sizes: ModelSizes) -> dict[str, object]:
    boosted = dict(maxIter=sizes.boosting_rounds, seed=sizes.seed)
    return {
        # The one-hot slots of a column add up to one, so plain least squares has no single solution; this has, next to it.
        "linear_regression": LinearRegression(regParam=1e-8, elasticNetParam=0.0, solver="normal"),
        "random_forest": RandomForestRegressor(
            numTrees=sizes.regression_trees, maxDepth=sizes.regression_depth, seed=sizes.seed, featureSubsetStrategy="all"
        ),
        "gradient_boosting": GBTRegressor(maxDepth=3, stepSize=0.1, **boosted),
        "boosted_depth3": GBTRegressor(maxDepth=3, stepSize=sizes.learning_rate, **boosted),
        "boosted_depth5": GBTRegressor(maxDepth=5, stepSize=sizes.learning_rate, **boosted),
    }


def _fit_regressors(names: Sequence[str], prepared: Prepared, sizes: ModelSizes) -> dict[str, object]:
    """The named candidates, fitted side by side. Stacking's boosted base is the candidate ``gradient_boosting``."""
    estimators = regressors(sizes)
    single = [n for n in names if n != "stacking_regressor"]
    work: dict = {}
    if "stacking_regressor" in names:
        work |= _stacking_folds(sizes)
        work["stacking_forest"] = (_stacking_bases(sizes)[0], None)
        single = list(dict.fromkeys(["gradient_boosting", *single]))
    work = {**{n: (estimators[n], None) for n in reversed(single)}, **work}
    fitted = prepared.fit_all(work)
    if "stacking_regressor" in names:
        bases = [fitted["stacking_forest"], fitted["gradient_boosting"]]
        fitted["stacking_regressor"] = _stacked(prepared, sizes, bases, fitted)
    return {n: fitted[n] for n in names}


# Task -> target, features, origin of the target, portfolio tier, decision use, stacking candidate
REGRESSION_TASKS = {
    "waiting_simulation": (
        "waiting_time_minutes", WAITING_FEATURES, "simulated_formula", "sandbox", "pipeline_demonstration", False,
    ),
    "revenue_scenario": (
        "revenue_per_patient", REVENUE_FEATURES, "mixed_surrogate_and_simulated", "sandbox", "scenario_demonstration", True,
    ),
}


INPUTS = {"readmission": READMISSION_FEATURES, **{t: v[1] for t, v in REGRESSION_TASKS.items()}}
TARGETS = {"readmission": "readmitted_30d", **{t: v[0] for t, v in REGRESSION_TASKS.items()}}


def train_regression(
    feat: DataFrame, task: str, sizes: ModelSizes = ModelSizes(), candidates: Sequence[str] | None = None
) -> TrainedModel:
    """Fit the candidates on a patient-disjoint split, select by RMSE and refit on all rows."""
    target, features, origin, tier, use, stacking = REGRESSION_TASKS[task]
    context = [c for c in ("admission_id", "patient_id", "department", "admit_date") if c not in features]
    base = _labelled(feat.select(*context, *features, target), target)
    train, test, audit_df = group_split(base, "patient_id", seed=sizes.seed)
    audit = audit_df.first().asDict()
    rows = audit["train_rows"]
    described = ["admission_id", "department", "admit_date", "ward_type", "label"]
    prepared = Prepared(features, train, rows, described)
    held = prepared.vectors(test).persist()
    names = list(candidates or [*regressors(sizes), *(["stacking_regressor"] if stacking else [])])
    holdouts = {
        n: on_vectors(m).transform(held).select(
            "admission_id", "department", "admit_date", "ward_type", F.col("label").alias("actual"), "prediction"
        )
        for n, m in _fit_regressors(names, prepared, sizes).items()
    }
    found = run_all(feat.sparkSession, {n: lambda h=h: regression_metrics(h, "actual").first().asDict() for n, h in holdouts.items()})
    table = [{"model": n, **found[n], **audit, "target_origin": origin} for n in names]
    prepared.release()
    table.sort(key=lambda r: r["rmse"])
    best = table[0]["model"]
    total = rows + audit["test_rows"]
    everything = Prepared(features, base, total, described)
    model = _fit_regressors([best], everything, sizes)[best]
    everything.release()
    lineage = _lineage(task, best, "RMSE", table[0]["rmse"], features, audit, origin, tier, use, model, total)
    return TrainedModel(task, model, _metric_table(feat.sparkSession, table), lineage, features, holdouts[best])


def ward_predictions(holdout: DataFrame) -> DataFrame:
    """Actual and predicted totals per ward on the held-out rows."""
    return holdout.groupBy("ward_type").agg(F.sum("actual").alias("actual"), F.sum("prediction").alias("predicted"))


def residuals(holdout: DataFrame) -> DataFrame:
    return holdout.withColumn("residual", F.col("actual") - F.col("prediction"))


REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("task", T.StringType()),
        T.StructField("selected_model", T.StringType()),
        T.StructField("primary_metric", T.StringType()),
        T.StructField("primary_metric_value", T.DoubleType()),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("split_strategy", T.StringType()),
        T.StructField("train_rows", T.LongType()),
        T.StructField("test_rows", T.LongType()),
        T.StructField("patient_overlap", T.LongType()),
        T.StructField("target_origin", T.StringType()),
        T.StructField("portfolio_tier", T.StringType()),
        T.StructField("decision_use", T.StringType()),
        T.StructField("model_hash", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("artifact_hash", T.StringType()),
        T.StructField("artifact_intact", T.BooleanType()),
    ]
)


def registry(spark, lineages: Sequence[dict]) -> DataFrame:
    """Lineage table, one row per trained task."""
    return spark.createDataFrame([tuple(e.get(f.name) for f in REGISTRY_SCHEMA) for e in lineages], REGISTRY_SCHEMA)


def grid_search(
    feat: DataFrame, trees: Sequence[int] = (80, 120), depths: Sequence[int] = (8, 12), leaves: Sequence[int] = (1, 3),
    folds: int = 3, parallelism: int = 8, seed: int = CONFIG.random_state,
) -> DataFrame:
    """Cross-validated ROC-AUC per forest setting; all rows of a patient share a fold."""
    base = _labelled(feat.select("patient_id", *READMISSION_FEATURES, "readmitted_30d"), "readmitted_30d")
    train, _, audit = group_split(base, "patient_id", seed=seed)
    train = with_balanced_weights(train).withColumn("fold", _bucket("patient_id", seed + 1, folds))
    prepared = Prepared(READMISSION_FEATURES, train, audit.first()["train_rows"], ["label", "weight", "fold"])
    forest = RandomForestClassifier(seed=seed, weightCol="weight")
    grid = (
        ParamGridBuilder()
        .addGrid(forest.numTrees, list(trees))
        .addGrid(forest.maxDepth, list(depths))
        .addGrid(forest.minInstancesPerNode, list(leaves))
        .build()
    )
    search = CrossValidator(
        estimator=forest, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC"),
        numFolds=folds, foldCol="fold", parallelism=parallelism,
    ).fit(prepared.data)
    prepared.release()
    rows = [
        (p[forest.numTrees], p[forest.maxDepth], p[forest.minInstancesPerNode], float(score))
        for p, score in zip(grid, search.avgMetrics)
    ]
    return feat.sparkSession.createDataFrame(rows, "trees int, depth int, min_leaf int, roc_auc double").orderBy(F.desc("roc_auc"))
