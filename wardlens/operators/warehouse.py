"""Star schema built from the feature table and the linked bills."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.config import DEPARTMENTS
from wardlens.functions.columns import pick, position_in
from wardlens.operators.cleaning import PLACE
from wardlens.operators.features import governed_link


class Warehouse(Mapping):
    """Read-only mapping of table name to DataFrame.

    ``bill_lines`` may hold the bills that billing, claims and insurance were projected from, and ``bill_sums`` their
    totals per admission, stored next to the features; ``visit_lines`` are the features that the other tables were projected
    from, and ``ledgers`` gives both sides stored by month and patient. Views read these instead of joining the projections
    again; they are dropped when a table they stand for is replaced.
    """

    BILL_TABLES = ("billing", "claims", "insurance")
    VISIT_TABLES = (
        "patients", "departments", "doctors", "admissions", "diagnoses", "labs", "medicines", "model_features",
    )

    def __init__(
        self, tables: Mapping[str, DataFrame], bill_lines: DataFrame | None = None, bill_sums: DataFrame | None = None,
        visit_lines: DataFrame | None = None, ledgers: Callable[[], tuple[DataFrame, DataFrame]] | None = None,
    ):
        self._tables = dict(tables)
        self.bill_lines, self.bill_sums, self.visit_lines = bill_lines, bill_sums, visit_lines
        self._ledgers = ledgers

    def __getitem__(self, name: str) -> DataFrame:
        try:
            return self._tables[name]
        except KeyError:
            raise KeyError(f"the warehouse has no table {name!r}") from None

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def with_tables(self, extra: Mapping[str, DataFrame]) -> Warehouse:
        bills, visits = (not any(n in extra for n in names) for names in (self.BILL_TABLES, self.VISIT_TABLES))
        return Warehouse(
            {**self._tables, **extra}, self.bill_lines if bills else None, self.bill_sums if bills else None,
            self.visit_lines if visits else None, self._ledgers if bills and visits else None,
        )

    @property
    def ledgers(self) -> tuple[DataFrame, DataFrame] | None:
        """The stored visits and bills, written when a report first asks for them."""
        return self._ledgers() if self._ledgers is not None else None

    def register(self, prefix: str = "") -> None:
        """Expose every table as a temporary view for ``spark.sql``."""
        for name, df in self._tables.items():
            df.createOrReplaceTempView(prefix + name)


def patients(feat: DataFrame) -> DataFrame:
    """The attributes depend on the patient id alone, so any row of a patient gives the same result."""
    return feat.select("patient_id", "age", "gender", "age_group").dropDuplicates(["patient_id"])


def departments(spark: SparkSession) -> DataFrame:
    """The fixed departments, numbered from one. A range has an exact size, so joins broadcast it unasked."""
    number = F.col("id").cast("int")
    return spark.range(1, len(DEPARTMENTS) + 1, 1, 1).select(
        number.alias("department_id"), pick(DEPARTMENTS, number - 1).alias("department")
    )


def _department_id() -> Column:
    """The department number is the position in the fixed list: no join is needed to attach it."""
    return position_in(DEPARTMENTS, F.col("department")).alias("department_id")


def doctors(feat: DataFrame) -> DataFrame:
    distinct = feat.select("doctor_id", "department", "doctor_experience").dropDuplicates(["doctor_id"])
    return distinct.select("doctor_id", "department", "doctor_experience", _department_id())


def admissions(feat: DataFrame) -> DataFrame:
    whole = lambda c: F.round(c).cast("int").alias(c)
    return feat.select(
        "admission_id", "patient_id", "doctor_id", _department_id(), "hospital_id", "admit_date", "discharge_date",
        whole("los_days"), "admit_type", "ward_type", "discharge_type", whole("readmitted_30d"),
        whole("readmitted_7d"), "waiting_time_minutes",
    )


def diagnoses(feat: DataFrame) -> DataFrame:
    return feat.select("admission_id", "charlson_index", "disease_severity_score")


def procedures(feat: DataFrame) -> DataFrame:
    return feat.select("admission_id", F.round("num_procedures").cast("int").alias("num_procedures"))


def medicines(feat: DataFrame) -> DataFrame:
    return feat.select(
        "admission_id", "medicine_code", F.round("medicine_count").cast("int").alias("medicine_count"),
        "average_medicine_cost",
    )


def labs(feat: DataFrame) -> DataFrame:
    return feat.select("admission_id", "hba1c", "creatinine", "haemoglobin", "systolic_bp", "lab_abnormality_score")


def insurance(bill: DataFrame) -> DataFrame:
    """Providers numbered in name order; the window sees one row per provider."""
    return bill.select("insurance_provider").distinct().select(
        F.row_number().over(Window.orderBy("insurance_provider")).alias("insurance_id"), "insurance_provider"
    )


def with_insurance_id(bill: DataFrame, insurance: DataFrame) -> DataFrame:
    """Bills with the number of their payer; bills that already carry it are left alone."""
    return bill if "insurance_id" in bill.columns else bill.join(insurance, "insurance_provider", "left")


def billing(bill: DataFrame, insurance: DataFrame) -> DataFrame:
    return with_insurance_id(bill, insurance).select(
        "billing_id", "admission_id", "patient_id", "insurance_id", "payment_method", "claim_billing_date",
        "billed_amount", "paid_amount", "claim_gap",
    )


def claims(bill: DataFrame, insurance: DataFrame) -> DataFrame:
    return with_insurance_id(bill, insurance).select(
        F.concat(F.lit("CLINE-"), "billing_id").alias("claim_line_id"),
        F.coalesce("claim_id", F.concat(F.lit("NOCLAIM-"), "billing_id")).alias("claim_id"),
        "billing_id", "insurance_id", "claim_status", "claim_approved", "source_patient_id", "source_encounter_id",
        "linkage_method",
    )


def bill_sums(bill: DataFrame) -> DataFrame:
    """Per admission: bills, amounts, approvals and link, as every bill has exactly one claim line."""
    key = PLACE if PLACE in bill.columns else "admission_id"  # equal for linked bills
    return bill.where(F.col("admission_id").isNotNull()).groupBy(F.col(key).alias("admission_id")).agg(
        F.count("*").alias("fan"),
        F.sum("paid_amount").cast("decimal(28,2)").alias("paid"),
        F.sum("billed_amount").alias("billed"),
        F.sum("claim_gap").alias("gap"),
        F.count("claim_approved").alias("rated"),
        F.sum("claim_approved").alias("approved"),
        F.count("billing_id").alias("bills"),
        governed_link().alias("link"),
    )


def appointments(adm: DataFrame) -> DataFrame:
    return adm.select(
        F.concat(F.lit("APT-"), "admission_id").alias("appointment_id"),
        "admission_id", "patient_id", "doctor_id", "department_id", "admit_date",
        F.lit("Completed").alias("appointment_status"),
        F.lit("09:00:00").alias("scheduled_time"),
    )


def build_warehouse_tables(
    feat: DataFrame, bill: DataFrame, dimensions: Mapping[str, DataFrame] | None = None,
    sums: DataFrame | None = None, ledgers: Callable[[], tuple[DataFrame, DataFrame]] | None = None,
) -> Warehouse:
    """All thirteen tables. ``dimensions`` may supply already written patients, doctors and insurance, ``sums`` the
    written ``bill_sums`` of the same bills, ``ledgers`` both facts stored by month and patient."""
    given = dict(dimensions or {})
    payers = given.get("insurance") or insurance(bill)
    adm = admissions(feat)
    return Warehouse(
        {
            "patients": given.get("patients") or patients(feat),
            "departments": departments(feat.sparkSession),
            "doctors": given.get("doctors") or doctors(feat),
            "admissions": adm,
            "diagnoses": diagnoses(feat),
            "procedures": procedures(feat),
            "medicines": medicines(feat),
            "labs": labs(feat),
            "insurance": payers,
            "billing": billing(bill, payers),
            "claims": claims(bill, payers),
            "appointments": appointments(adm),
            "model_features": feat,
        },
        bill_lines=bill,
        bill_sums=sums,
        visit_lines=feat,
        ledgers=ledgers,
    )
