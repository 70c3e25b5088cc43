"""Bed-census features, baseline and recursive forecasts, one series per key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.config import CONFIG
from wardlens.functions.columns import flag
from wardlens.functions.shipping import ship_package
from wardlens.ml.concurrent import run_all
from wardlens.ml.metrics import regression_metrics
from wardlens.ml.models import ModelSizes, TrainedModel, model_signature
from wardlens.ml.trees import flat_trees

HOSPITAL = "Hospital portfolio"
OCCUPANCY_FEATURES = ("dayofweek", "month", "is_weekend", "lag_1_beds", "lag_7_beds", "rolling_7_beds")


def census_by(feat: DataFrame, key: str | None = None) -> DataFrame:
    """Daily census per value of ``key`` (or of the whole hospital) on the full calendar.

    Rows are counted per key and day first; the running sum then sees at most one row per calendar day.
    """
    keyed = feat.withColumn("series", F.col(key) if key else F.lit(HOSPITAL))
    admits = keyed.groupBy("series", F.col("admit_date").alias("date")).agg(F.count("*").alias("change"))
    leaves = (
        keyed.where("discharge_date IS NOT NULL")
        .groupBy("series", F.date_add("discharge_date", 1).alias("date"))
        .agg((-F.count("*")).alias("change"))
    )
    changes = admits.unionByName(leaves).groupBy("series", "date").agg(F.sum("change").alias("change"))
    first, last = (feat.agg(f("admit_date")).scalar() for f in (F.min, F.max))
    days = admits.select("series").distinct().select(
        "series", F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date")
    )
    so_far = Window.partitionBy("series").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return (
        days.join(changes, ["series", "date"], "left")
        .withColumn("occupied_beds", F.greatest(F.sum(F.coalesce("change", F.lit(0))).over(so_far), F.lit(0)))
        .select("series", "date", "occupied_beds")
    )


def occupancy_features(daily: DataFrame) -> DataFrame:
    """Calendar parts and lags per series; days without a full week of history are dropped."""
    days = Window.partitionBy("series").orderBy("date")
    week = days.rowsBetween(-7, -1)
    return (
        daily.withColumns(
            {
                "dayofweek": F.weekday("date"),
                "month": F.month("date"),
                "is_weekend": flag(F.weekday("date") >= 5),
                "lag_1_beds": F.lag("occupied_beds", 1).over(days),
                "lag_7_beds": F.lag("occupied_beds", 7).over(days),
                "rolling_7_beds": F.when(F.count("occupied_beds").over(week) == 7, F.avg("occupied_beds").over(week)),
            }
        )
        .dropna(subset=["lag_1_beds", "lag_7_beds", "rolling_7_beds"])
    )


def split_by_date(model_data: DataFrame, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """First share of the calendar days for training, the rest for testing, the same cut for every series."""
    days = model_data.select("date").distinct()
    cut = days.orderBy("date").limit(int(days.count() * share)).agg(F.max("date")).first()[0]
    return model_data.where(F.col("date") <= F.lit(cut)), model_data.where(F.col("date") > F.lit(cut))


def moving_average_baseline(model_data: DataFrame) -> DataFrame:
    """Mean of the previous seven days as prediction for each test day."""
    _, test = split_by_date(model_data)
    return test.select(
        "series", "date", F.col("occupied_beds").cast("double").alias("label"), F.col("rolling_7_beds").alias("prediction")
    )


def _assembled(model_data: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(OCCUPANCY_FEATURES), outputCol="features").transform(
        model_data.withColumn("label", F.col("occupied_beds").cast("double"))
    )


LINEAR, BOOSTED, AVERAGE = "linear_lags", "boosted_lags", "moving_average_7"


def fit_occupancy(
    model_data: DataFrame, name: str = LINEAR, sizes: ModelSizes = ModelSizes()
) -> LinearRegressionModel | GBTRegressionModel:
    if name == LINEAR:
        return LinearRegression(regParam=0.0).fit(_assembled(model_data))
    days = _assembled(model_data).select("features", "label").coalesce(1).persist()  # one row per calendar day and series
    boosted = GBTRegressor(maxIter=sizes.boosting_rounds, maxDepth=3, stepSize=sizes.learning_rate, seed=sizes.seed).fit(days)
    days.unpersist()
    return boosted


def compare_occupancy_models(model_data: DataFrame, sizes: ModelSizes = ModelSizes()) -> DataFrame:
    """Holdout metrics of the linear model, the boosted trees and the moving average."""
    train, test = split_by_date(model_data)
    fitted = run_all(model_data.sparkSession, {n: partial(fit_occupancy, train, n, sizes) for n in (BOOSTED, LINEAR)})
    tables = [regression_metrics(m.transform(_assembled(test))).withColumn("model", F.lit(n)) for n, m in fitted.items()]
    naive = regression_metrics(moving_average_baseline(model_data)).withColumn("model", F.lit(AVERAGE))
    return reduce(DataFrame.unionByName, tables, naive)


def train_occupancy(daily: DataFrame, sizes: ModelSizes = ModelSizes()) -> TrainedModel:
    """The learned candidate with the smallest mean error on the last fifth of the days, refitted on all days."""
    model_data = occupancy_features(daily)
    table = [r.asDict() for r in compare_occupancy_models(model_data, sizes).collect()]
    best = min((r for r in table if r["model"] != AVERAGE), key=lambda r: (r["mae"], r["model"]))
    model = fit_occupancy(model_data, best["model"], sizes)
    lineage = occupancy_lineage(best, daily.count(), model_signature(model))
    metrics = daily.sparkSession.createDataFrame([tuple(r.values()) for r in table], list(table[0]))
    return TrainedModel("occupancy", model, metrics, lineage, OCCUPANCY_FEATURES)


FORECAST_SCHEMA = "series string, forecast_date date, forecast_occupied_beds double, forecast_occupancy_pct double"


class _Linear:
    """A linear model's prediction for rows of ``OCCUPANCY_FEATURES``, outside of a DataFrame."""

    def __init__(self, model: LinearRegressionModel):
        self.weights, self.intercept = np.array(model.coefficients, float), float(model.intercept)

    def predict(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.weights + self.intercept


def forecast_recursive(
    daily: DataFrame, model: LinearRegressionModel | GBTRegressionModel, horizon: int = 90, capacity: int = CONFIG.bed_capacity
) -> DataFrame:
    """Day-by-day forecast per series, each prediction feeding the next lags.

    Only the last seven days of every series are shipped, as one row whatever the history; all series of a batch take
    each step together, so a linear model costs one product and an ensemble one walk through its trees per day. A series
    of fewer than seven days counts its first day's beds for the days before.
    """
    spark = daily.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(_Linear(model) if hasattr(model, "coefficients") else flat_trees(spark, model))

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = shared.value.predict
        for past in batches:
            if past.empty:
                continue
            beds = np.array([([w[0]] * (7 - len(w)) + list(w)) for w in past["week"]], float)
            last = pd.to_datetime(past["last"])
            steps, dates = [], []
            for step in range(1, horizon + 1):
                date = last + pd.Timedelta(days=step)
                weekday = date.dt.dayofweek.to_numpy()
                week = beds[:, -7:]
                rows = np.column_stack([weekday, date.dt.month, weekday >= 5, week[:, -1], week[:, 0], week.mean(axis=1)]).astype(float)
                ahead = np.maximum(predict(rows), 0.0)
                beds = np.column_stack([week[:, 1:], ahead])
                steps.append(ahead)
                dates.append(date.dt.date.to_numpy())
            found = np.concatenate(steps)
            yield pd.DataFrame(
                {
                    "series": np.tile(past["series"].to_numpy(), horizon),
                    "forecast_date": np.concatenate(dates),
                    "forecast_occupied_beds": found,
                    "forecast_occupancy_pct": np.minimum(found / capacity * 100, 100.0),
                }
            )

    last_day = daily.agg(F.max("date")).scalar()
    day = F.struct("date", F.col("occupied_beds").cast("double").alias("beds"))
    recent = daily.where(F.col("date") > F.date_sub(last_day, 7)).groupBy("series").agg(
        F.transform(F.sort_array(F.collect_list(day)), lambda d: d["beds"]).alias("week"), F.max("date").alias("last")
    )
    return recent.mapInPandas(extend, FORECAST_SCHEMA)


def horizon_summary(forecast: DataFrame, horizons: Sequence[int] = (7, 30, 90)) -> DataFrame:
    """Mean beds and occupancy over the first days of each horizon."""
    first = forecast.agg(F.min("forecast_date")).scalar()
    offset = F.datediff("forecast_date", first) + 1
    picked = forecast.withColumn("day_number", offset).withColumn(
        "horizon_days", F.explode(F.array(*[F.lit(h) for h in horizons]))
    )
    return (
        picked.where("day_number <= horizon_days")
        .groupBy("series", "horizon_days")
        .agg(
            F.avg("forecast_occupied_beds").alias("forecast_occupied_beds"),
            F.avg("forecast_occupancy_pct").alias("forecast_occupancy_pct"),
        )
        .orderBy("series", "horizon_days")
    )


def occupancy_lineage(metrics_row: dict, rows: int, signature: str) -> dict:
    return {
        "task": "occupancy", "selected_model": metrics_row["model"], "primary_metric": "MAE_beds",
        "primary_metric_value": float(metrics_row["mae"]), "features": list(OCCUPANCY_FEATURES),
        "split_strategy": "chronological_80_20", "target_origin": "observed_active_census",
        "portfolio_tier": "core_analytical", "decision_use": "capacity_scenario", "model_hash": signature, "rows": rows,
    }
