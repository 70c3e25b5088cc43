"""Scoring and explanations of the registered models over all admissions.

Contributions of linear models and tree ensembles are arrays built and ranked inside one row, so explaining every admission needs no
shuffle. Permutation importance works for every model, stacked and voting ones included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.config import CONFIG, OpsConfig
from wardlens.functions.columns import mean, ratio
from wardlens.functions.scale import materialize, materialize_small, with_row_index
from wardlens.ml import trees
from wardlens.ml.metrics import roc_auc_by
from wardlens.ml.models import Stacked, Voting, feature_names, predict_class, split_features

# Display names of the readmission features.
FEATURE_LABELS = {
    "los_days": "Length of stay",
    "num_procedures": "Procedure count",
    "charlson_index": "Charlson comorbidity index",
    "hba1c": "HbA1c",
    "creatinine": "Creatinine",
    "haemoglobin": "Haemoglobin",
    "systolic_bp": "Systolic blood pressure",
    "previous_admissions": "Previous admissions",
    "readmission_history": "Readmission history",
    "disease_severity_score": "Disease severity score",
    "lab_abnormality_score": "Abnormal lab indicators",
    "patient_complexity_index": "Patient complexity index",
    "admit_type": "Admission type",
    "ward_type": "Ward type",
    "season": "Admission season",
}
WHOLE_NUMBERS = ("num_procedures", "previous_admissions", "readmission_history", "lab_abnormality_score")
UNITS = {"los_days": " days", "systolic_bp": " mmHg"}
NEGLIGIBLE = 1e-12


def score_readmission(model, feat: DataFrame, config: OpsConfig = CONFIG) -> DataFrame:
    """Probability and risk label of every admission."""
    p = F.col("probability")
    label = F.when(p >= config.high_risk_threshold, "HIGH RISK").when(p >= config.monitor_threshold, "MONITOR").otherwise("LOW RISK")
    return predict_class(model, feat).select("admission_id", "patient_id", "probability", label.alias("risk_label"))


def scenario_scores(model, feat: DataFrame, target: str, volume: int = 1) -> DataFrame:
    """Prediction floored at zero, its total for a planned volume and the difference to the department mean."""
    baseline = feat.groupBy("department").agg(mean(target).alias("department_mean"))
    # The observed target is not a model input; it is left out so predictions cannot touch it.
    scored = model.transform(feat.drop("prediction"))
    value = F.greatest(F.col("prediction"), F.lit(0.0))
    return (
        scored.select("admission_id", "department", value.alias("predicted"))
        .join(F.broadcast(baseline), "department", "left")  # one row per fixed department
        .select(
            "admission_id", "department", "predicted",
            (F.col("predicted") * volume).alias("planned_total"),
            (F.col("predicted") - F.col("department_mean")).alias("difference_to_department"),
        )
    )


def explained_member(model: object) -> PipelineModel:
    """The model whose contributions are shown: a vote is explained by its first member."""
    return model.members[0] if isinstance(model, Voting) else model


def is_additive(model: object) -> bool:
    """Whether a score is a sum of contributions: linear models and tree ensembles."""
    if isinstance(model, (Voting, Stacked)):
        return False
    last = trees.last_stage(model)
    return hasattr(last, "coefficients") or trees.is_ensemble(last)


def _source(name: str, features: Sequence[str]) -> tuple[str, str | None]:
    """Original column and category of a vector slot."""
    if name.startswith("numeric__"):
        return name.removeprefix("numeric__"), None
    encoded = name.removeprefix("categorical__")
    column = next(c for c in split_features(features)[1] if encoded.startswith(f"{c}_"))
    return column, encoded.removeprefix(f"{column}_")


def _shown(column: str, category: str | None) -> Column:
    if category is not None:
        return F.lit(category)
    value = F.col(column).cast("double")
    digits = 0 if column in UNITS or column in WHOLE_NUMBERS else 2
    return F.format_string(f"%.{digits}f{UNITS.get(column, '')}", value)


def with_contributions(
    model: PipelineModel, feat: DataFrame, features: Sequence[str], centre: Sequence[float] | None = None
) -> DataFrame:
    """Add ``logit`` (or prediction) and the array ``contributions``.

    Of a linear model: slot value, less its ``centre`` if given, times coefficient. Of a tree ensemble: what the splits on a slot add
    to the value before any split, which is the average already; the sum is a forest's share or prediction and half the
    log odds of boosted classification trees.
    """
    if not is_additive(model):
        raise TypeError("contributions need a linear model or a tree ensemble")
    last, names = model.stages[-1], feature_names(model, features)
    scored = model.transform(feat)
    if hasattr(last, "coefficients"):
        prepared, base = scored.withColumn("slots", vector_to_array("features")), float(last.intercept)
        offsets = centre if centre is not None else [0.0] * len(names)
        parts = [(F.col("slots")[k] - float(o)) * float(w) for k, (o, w) in enumerate(zip(offsets, last.coefficients))]
    else:
        flat = trees.flat_trees(feat.sparkSession, last)
        prepared, base = trees.with_contributions(scored, flat, "slots"), flat.base
        parts = [F.col("slots")[k] for k in range(len(names))]
    entries = []
    for name, part in zip(names, parts):
        column, category = _source(name, features)
        entries.append(
            F.struct(
                F.lit(name).alias("transformed_feature"),
                F.lit(FEATURE_LABELS.get(column, column.replace("_", " ").title())).alias("feature"),
                _shown(column, category).alias("observed_value"),
                part.alias("contribution"),
            )
        )
    total = F.aggregate("contributions", F.lit(base), lambda acc, x: acc + x["contribution"])
    return prepared.withColumn("contributions", F.array(*entries)).withColumn("logit", total)


def linear_contributions(model: PipelineModel, feat: DataFrame, features: Sequence[str], top_n: int = 4) -> DataFrame:
    """The strongest contributions of every admission, ranked by size; of a vote, those of its first member."""
    model = explained_member(model)
    prepared = with_contributions(model, feat, features)
    kept = F.filter("contributions", lambda x: F.abs(x["contribution"]) > NEGLIGIBLE)
    keyed = F.transform(
        kept, lambda x: F.struct((-F.abs(x["contribution"])).alias("size"), x["transformed_feature"].alias("k"), x.alias("c"))
    )
    ranked = F.slice(F.sort_array(keyed), 1, top_n)
    exploded = prepared.select("admission_id", "patient_id", F.posexplode(ranked).alias("position", "entry"))
    raises = F.col("entry.c.contribution") > 0
    return exploded.select(
        "admission_id", "patient_id",
        (F.col("position") + 1).alias("driver_rank"),
        "entry.c.transformed_feature", "entry.c.feature", "entry.c.observed_value", "entry.c.contribution",
        F.when(raises, "Raises model score").otherwise("Lowers model score").alias("direction"),
        F.when(raises, "trending_up").otherwise("trending_down").alias("icon"),
    )


def slot_means(model: PipelineModel, feat: DataFrame) -> list[float]:
    """Mean of every vector slot: as many numbers as the model has inputs."""
    return [float(v) for v in model.transform(feat).select(Summarizer.mean(F.col("features"))).first()[0]]


def global_importance(
    model: object, feat: DataFrame, features: Sequence[str], top_n: int = 50, target: str | None = None
) -> DataFrame:
    """Mean absolute contribution per slot, of linear models around the average admission; a vote is explained by its first member.

    A stacked model has no contributions of its own: its importance is that of its permuted inputs, for which ``target`` is needed.
    """
    model = explained_member(model)
    if not is_additive(model):
        table = permutation_importance(model, feat, features, target).select("feature", "importance")
        return table.orderBy(F.desc("importance"), "feature").limit(top_n)
    names = feature_names(model, features)
    centre = slot_means(model, feat) if hasattr(model.stages[-1], "coefficients") else None
    centred = with_contributions(model, feat, features, centre)
    sizes = centred.agg(
        *[F.avg(F.abs(F.col("contributions")[k]["contribution"])).alias(n) for k, n in enumerate(names)]
    )
    quoted = sizes.unpivot([], list(names), "feature", "importance")
    return quoted.orderBy(F.desc("importance"), "feature").limit(top_n)


NOTHING = ""  # name of the variant in which no column is permuted


def permuted_variants(df: DataFrame, key: str, features: Sequence[str], seed: int = CONFIG.random_state) -> DataFrame:
    """Every row once as it is and once per feature with that feature's value taken from another row; ``permuted`` names it.

    Rows are put in the order of a hash of their key and numbered; the other row is the one a keyed number of places further, cyclically.
    So each column is permuted as a whole, one row is shuffled once, and all variants leave the same join.
    """
    text = F.col(key).cast("string")
    ordered = df.withColumn("_order", F.md5(F.concat(F.lit(f"{seed}:"), text))).withColumn("_key", text)
    placed = materialize(with_row_index(ordered, ["_order", "_key"], "permutation", "_place").drop("_order", "_key"), "permutation")
    rows = placed.count()
    step = 1 + int(hashlib.md5(str(seed).encode()).hexdigest(), 16) % (rows - 1) if rows > 1 else 0
    others = placed.select(
        F.pmod(F.col("_place") - step, F.lit(max(rows, 1))).alias("_place"), F.struct(*features).alias("_other")
    )
    variants = F.explode(F.array(*[F.lit(n) for n in (NOTHING, *features)])).alias("permuted")
    both = placed.join(others, "_place").select(*df.columns, "_other", variants)
    swapped = {f: F.when(F.col("permuted") == f, F.col(f"_other.{f}")).otherwise(F.col(f)) for f in features}
    return both.withColumns(swapped).drop("_other")


def permutation_importance(
    model: object, feat: DataFrame, features: Sequence[str], target: str, classes: bool = False,
    key: str = "admission_id", seed: int = CONFIG.random_state,
) -> DataFrame:
    """Per feature: the score without and with its column permuted, and how much worse that is.

    The score is the area under the ROC curve for ``classes``, else the root of the mean squared error.
    """
    kept = feat.select(key, *features, F.col(target).cast("double").alias("label")).where("label IS NOT NULL")
    variants = permuted_variants(kept, key, features, seed)
    if classes:
        scored = materialize(predict_class(model, variants).select("permuted", "label", "probability"), "permuted")
        scores = roc_auc_by(scored, "permuted").withColumnRenamed("roc_auc", "score")
    else:
        error = F.col("label") - F.col("prediction")
        scores = model.transform(variants).groupBy("permuted").agg(F.sqrt(ratio(F.sum(error * error), F.count("*"))).alias("score"))
    scores = materialize_small(scores, "permuted_scores")
    whole = scores.where(F.col("permuted") == NOTHING).agg(F.max("score")).scalar()
    worse = F.col("baseline") - F.col("score") if classes else F.col("score") - F.col("baseline")
    return scores.where(F.col("permuted") != NOTHING).withColumn("baseline", whole).select(
        F.col("permuted").alias("feature"), "baseline", F.col("score").alias("permuted_score"), worse.alias("importance")
    )


def top_positive_driver(model: PipelineModel, feat: DataFrame, features: Sequence[str]) -> DataFrame:
    """Strongest raising factor of every admission; the first slot where nothing raises the score."""
    model = explained_member(model)
    centre = slot_means(model, feat) if hasattr(model.stages[-1], "coefficients") else None
    centred = with_contributions(model, feat, features, centre)
    pair = lambda x: F.struct(x["contribution"].alias("factor_contribution"), x["transformed_feature"].alias("top_risk_factor"))
    positive = F.transform(F.filter("contributions", lambda x: x["contribution"] > 0), pair)
    best = F.coalesce(F.array_max(positive), F.get(F.transform("contributions", pair), F.lit(0)))
    return centred.select("admission_id", "patient_id", best.alias("best")).select(
        "admission_id", "patient_id", "best.top_risk_factor", "best.factor_contribution"
    )
