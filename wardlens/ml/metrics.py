"""Model metrics computed from a prediction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.columns import ratio
from wardlens.functions.scale import beside, running_totals


def roc_auc(pred: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """Area under the ROC curve with ties at their average rank, one row.

    Rows are counted per distinct score, then negatives are accumulated over a range partitioning of the
    scores: nothing is sorted in one task, and all counts are exact integers.
    """
    counts = (
        pred.where(F.col(label).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )
    ranked = running_totals(counts, ["score"], {"neg_up_to": F.col("neg")}, "roc")
    # Twice the wins of each positive: every lower negative counts two, every tied negative one.
    wins = F.sum((F.col("pos") * (F.col("neg_up_to") * 2 - F.col("neg"))).cast("decimal(38,0)"))
    pairs = F.sum("pos").cast("double") * F.sum("neg") * 2
    return ranked.agg(F.try_divide(wins.cast("double"), pairs).alias("roc_auc"))


def roc_auc_by(pred: DataFrame, by: str, label: str = "label", score: str = "probability") -> DataFrame:
    """``roc_auc`` per value of ``by``, all from one sweep over the scores of all groups."""
    counts = (
        pred.where(F.col(label).isNotNull())
        .groupBy(by, F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )
    ranked = running_totals(counts, [by, "score"], {"neg_up_to": F.col("neg")}, "roc")
    # The sweep goes on from group to group: each group's own total starts where its smallest running total does.
    per_group = ranked.groupBy(by).agg(
        F.sum((F.col("pos") * (F.col("neg_up_to") * 2 - F.col("neg"))).cast("decimal(38,0)")).alias("wins"),
        F.min(F.col("neg_up_to") - F.col("neg")).alias("before"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
    )
    own = F.col("wins") - F.col("pos").cast("decimal(20,0)") * F.col("before") * 2
    pairs = F.col("pos").cast("double") * F.col("neg") * 2
    return per_group.select(by, F.try_divide(own.cast("double"), pairs).alias("roc_auc"))


def classification_metrics(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "probability"
) -> DataFrame:
    """Accuracy, precision, recall, F1 (zero where undefined), confusion counts and ROC-AUC in one row."""
    actual, predicted = F.col(label) == 1, F.col(prediction) == 1
    counts = pred.where(F.col(label).isNotNull()).agg(
        F.count_if(~actual & ~predicted).alias("tn"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(actual & predicted).alias("tp"),
    )
    zero = F.lit(0.0)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    rates = counts.select(
        ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        F.coalesce(ratio(tp, tp + fp), zero).alias("precision"),
        F.coalesce(ratio(tp, tp + fn), zero).alias("recall"),
        F.coalesce(ratio(tp * 2, tp * 2 + fp + fn), zero).alias("f1"),
        "tn", "fp", "fn", "tp",
    )
    return beside(rates, roc_auc(pred, label, score))


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE, MAPE with the denominator floored at one, and R2, from one aggregation."""
    y, error = F.col(label).cast("double"), F.col(label).cast("double") - F.col(prediction)
    sums = pred.agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(1.0))).alias("mape"),
        F.var_pop(y).alias("spread"),
    )
    return sums.select(
        F.sqrt("mse").alias("rmse"), "mae", "mape", (1 - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2")
    )
