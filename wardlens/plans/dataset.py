"""One data set and its written stages: raw -> clean -> linked bills and features -> warehouse -> marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from wardlens.config import CONFIG, OpsConfig
from wardlens.functions.scale import bucket_count, materialize_bucketed, materialize_small
from wardlens.ml import explain, forecasting, models, store
from wardlens.ml.concurrent import run_all
from wardlens.operators import cleaning, contracts, ledgers, marts, warehouse
from wardlens.operators.features import engineer_features
from wardlens.operators.warehouse import Warehouse
from wardlens.sources import fixtures


class HospitalData:
    """Each stage is written at most once and read back by everything that follows.

    Features, bills and the bill totals per admission are bucketed by admission id. The warehouse fact
    tables are projections of features and bills; views take bill amounts from the totals and flat bills from one scan.
    """

    model_sizes = models.ModelSizes()  # of every candidate; the tests set smaller ones

    def __init__(self, raw_admissions: DataFrame, raw_billing: DataFrame, config: OpsConfig = CONFIG):
        self.raw_admissions = raw_admissions
        self.raw_billing = raw_billing
        self.config = config
        self.spark = raw_admissions.sparkSession
        self._trained: dict[tuple, models.TrainedModel] = {}
        self.models = store.ModelStore(self.spark)

    @cached_property
    def admissions_clean(self) -> DataFrame:
        return cleaning.clean_admissions(self.raw_admissions)

    @cached_property
    def billing_clean(self) -> DataFrame:
        return cleaning.clean_billing(self.raw_billing)

    @cached_property
    def insurance(self) -> DataFrame:
        return materialize_small(warehouse.insurance(self.billing_clean), "insurance")

    @cached_property
    def buckets(self) -> int:
        """Of bills, their totals and features alike: all three lie by admission."""
        return bucket_count(self.spark, max(self.billing_clean.count(), self.admissions_clean.count()))

    @cached_property
    def placed_bills(self) -> DataFrame:
        """Linked bills with their payer number, stored by admission."""
        linked = cleaning.place_billing_by_encounter(self.billing_clean, self.admissions_clean, self.buckets)
        numbered = warehouse.with_insurance_id(linked, self.insurance)
        return materialize_bucketed(numbered, "billing", cleaning.PLACE, self.buckets, partitioned=True)

    @cached_property
    def billing_linked(self) -> DataFrame:
        """The linked bills, so billing and claims are projections of one table."""
        return self.placed_bills.drop(cleaning.PLACE)

    @cached_property
    def bill_sums(self) -> DataFrame:
        """Bill totals per admission, bucketed like the features, so views join them without a shuffle."""
        sums = warehouse.bill_sums(self.placed_bills)
        return materialize_bucketed(sums, "bill_sums", "admission_id", self.buckets, partitioned=True)

    @cached_property
    def features(self) -> DataFrame:
        feat = engineer_features(self.admissions_clean, self.billing_linked, self.buckets, self.bill_sums)
        return materialize_bucketed(feat, "features", "admission_id", self.buckets, partitioned=True)

    @cached_property
    def warehouse(self) -> Warehouse:
        written: Mapping[str, DataFrame] = {
            "patients": materialize_small(warehouse.patients(self.features), "patients"),
            "doctors": materialize_small(warehouse.doctors(self.features), "doctors"),
            "insurance": self.insurance,
        }
        return warehouse.build_warehouse_tables(self.features, self.billing_linked, written, self.bill_sums, lambda: self.ledgers)

    @cached_property
    def ledgers(self) -> tuple[DataFrame, DataFrame]:
        """Visits and bills stored by month and patient, written when a report of one of either first needs them."""
        return ledgers.visit_ledger(self.features, self.bill_sums), ledgers.bill_ledger(self.billing_linked)

    @cached_property
    def marts(self) -> dict[str, DataFrame]:
        return marts.build_marts(self.features, self.warehouse["billing"], None, self.config, materialize_small)

    @cached_property
    def warehouse_with_marts(self) -> Warehouse:
        return self.warehouse.with_tables(self.marts)

    @cached_property
    def census(self) -> DataFrame:
        """Daily census of the whole hospital: one row per calendar day."""
        return materialize_small(forecasting.census_by(self.features), "census")

    @cached_property
    def occupancy_forecast(self) -> DataFrame:
        model = self.trained("occupancy").model
        forecast = forecasting.forecast_recursive(self.census, model, capacity=self.config.bed_capacity)
        return materialize_small(forecast, "occupancy_forecast")

    @cached_property
    def marts_with_forecast(self) -> dict[str, DataFrame]:
        """The marts with the additional beds taken from the trained bed forecast."""
        return marts.build_marts(self.features, self.warehouse["billing"], self.occupancy_forecast, self.config)

    @cached_property
    def fingerprint(self) -> str:
        """Names the content of the features: models of equal features are the same models."""
        row = contracts.dataset_fingerprint(self.features).first()
        return f"{row['rows']}-{row['content_hash']}"

    def _train(self, task: str) -> models.TrainedModel:
        if task == "readmission":
            return models.train_readmission(self.features, self.model_sizes)
        if task == "occupancy":
            return forecasting.train_occupancy(self.census, self.model_sizes)
        return models.train_regression(self.features, task, self.model_sizes)

    def stored(self, task: str) -> store.Stored:
        """The task's model in the store: fitted once per content, sizes and inputs, whatever application asks."""
        key = store.model_key(task, self.fingerprint, self.model_sizes, models.INPUTS.get(task, forecasting.OCCUPANCY_FEATURES))
        return self.models.obtain(key, lambda: self._train(task))

    def stored_all(self, tasks: Sequence[str]) -> dict[str, store.Stored]:
        """The stored models of several tasks; those that are not there yet are trained side by side."""
        _ = self.fingerprint, self.census  # before several threads ask for them
        return run_all(self.spark, {t: partial(self.stored, t) for t in tasks})

    def trained(self, task: str) -> models.TrainedModel:
        """The stored model with its metrics and held-out predictions."""
        key = (task, self.model_sizes)
        if key not in self._trained:
            self._trained[key] = self.stored(task).read()
        return self._trained[key]

    def explanation(self, task: str) -> DataFrame:
        """The published importance of the registered model's inputs."""
        target = models.TARGETS[task]
        return self.stored(task).explain(lambda t: explain.global_importance(t.model, self.features, t.features, target=target))

    @cached_property
    def readmission_logistic(self) -> models.TrainedModel:
        return models.train_readmission(self.features, candidates=("logistic",))


_open: dict[tuple[str, str], HospitalData] = {}


def open_fixture(spark: SparkSession, sf_dir: str) -> HospitalData:
    """The data set of one fixture folder, shared by all queries of a Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        _open[key] = HospitalData(fixtures.raw_admissions(spark, sf_dir), fixtures.raw_billing(spark, sf_dir))
    return _open[key]
