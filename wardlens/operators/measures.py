"""Slicer-style measures over the warehouse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.functions.columns import flag, mean, ratio
from wardlens.functions.scale import beside
from wardlens.operators.marts import calendar, day_span
from wardlens.operators.reports import monthly_finance
from wardlens.operators.views import Tables


def _sliced_admissions(wh: Tables, by: Sequence[str]) -> DataFrame:
    """Admissions with the requested department or patient attributes."""
    adm = wh["admissions"]
    if "department" in by:
        adm = adm.join(F.broadcast(wh["departments"]), "department_id", "left")
    wanted = [c for c in by if c in ("age", "gender", "age_group")]
    if wanted:
        adm = adm.join(wh["patients"].select("patient_id", *wanted), "patient_id", "left")
    return adm


def _money(wh: Tables) -> DataFrame:
    """Amounts and approvals per admission: stored ones, or summed from bills and claims."""
    if getattr(wh, "bill_sums", None) is not None:
        return wh.bill_sums.drop("fan", "bills", "link")
    approvals = wh["claims"].groupBy("billing_id").agg(
        F.sum("claim_approved").alias("approved"), F.count("claim_approved").alias("rated")
    )
    return (
        wh["billing"]
        .select("billing_id", "admission_id", "billed_amount", "paid_amount", "claim_gap")
        .join(approvals, "billing_id", "left")
        .groupBy("admission_id")
        .agg(
            F.sum("paid_amount").alias("paid"), F.sum("billed_amount").alias("billed"), F.sum("claim_gap").alias("gap"),
            F.sum("approved").alias("approved"), F.sum("rated").alias("rated"),
        )
    )


def measures(wh: Tables, by: Sequence[str] = ()) -> DataFrame:
    """Care, finance and workload measures for any admission, department or patient slicers.

    Bills are summed per admission before the join, so each admission contributes one row.
    """
    money = _money(wh)
    doctors = wh["doctors"].agg(F.countDistinct("doctor_id")).scalar()
    weekend = flag(F.weekday("admit_date") >= 5)
    grouped = (
        _sliced_admissions(wh, by)
        .join(money, "admission_id", "left")
        .groupBy(*by)
        .agg(
            F.count("admission_id").alias("admissions"),
            F.countDistinct("patient_id").alias("patients"),
            mean("readmitted_30d").alias("readmission_rate"),
            mean("los_days").alias("average_los"),
            mean("waiting_time_minutes").alias("average_wait"),
            F.sum("paid").alias("paid_revenue"),
            F.sum("billed").alias("billed_revenue"),
            F.sum("gap").alias("revenue_leakage"),
            ratio(F.sum("approved"), F.sum("rated")).alias("claim_approval_ratio"),
            F.sum(weekend).alias("weekend_admissions"),
        )
    )
    return (
        grouped.withColumn("revenue_per_patient", ratio(F.col("paid_revenue"), F.col("patients")))
        .withColumn("admissions_per_doctor", ratio(F.col("admissions"), doctors))
        .withColumn("weekend_admission_rate", ratio(F.col("weekend_admissions"), F.col("admissions")))
    )


def revenue_growth(wh: Tables) -> DataFrame:
    """Paid revenue per month with the month before and the growth over it."""
    months = monthly_finance(wh["billing"]).select("month_start", F.col("paid").alias("paid_revenue"))
    prior = F.lag("paid_revenue").over(Window.orderBy("month_start"))
    growth = ratio(F.col("paid_revenue") - F.col("prior_month_revenue"), F.col("prior_month_revenue"))
    return months.withColumn("prior_month_revenue", prior).withColumn("monthly_revenue_growth", growth)


def trailing_admissions(wh: Tables, days: int = 30) -> DataFrame:
    """Admissions of the trailing days, for every calendar day."""
    adm = wh["admissions"]
    daily = adm.groupBy(F.col("admit_date").alias("date")).agg(F.count("*").alias("n"))
    dense = calendar(day_span(adm)).join(daily, "date", "left").select("date", F.coalesce("n", F.lit(0)).alias("n"))
    frame = Window.orderBy(F.unix_date("date")).rangeBetween(1 - days, 0)
    return dense.select("date", F.sum("n").over(frame).alias(f"admissions_{days}d"))


def command_center_measures(wh: Tables) -> DataFrame:
    """The governed single-row measures, percentages as shares."""
    share = lambda c: (F.col(c) / 100).alias(c.removesuffix("_pct") + "_share")
    center = wh["command_center_kpis"].select(
        "patients_today", share("occupancy_pct"), "occupied_beds",
        F.col("emergency_wait_minutes").alias("emergency_wait"), "critical_patients",
        share("doctor_utilization_pct"), "hospital_efficiency_score",
    )
    outlook = wh["operational_forecast_summary"].select(
        F.col("emergency_patients").alias("next_week_emergency_patients"), share("emergency_growth_pct"),
        F.col("additional_beds").alias("additional_beds_required"), F.col("peak_day").alias("peak_forecast_day"),
    )
    return beside(center, outlook)


def department_efficiency_score(wh: Tables) -> DataFrame:
    """Department scores; the unsliced measure is their maximum."""
    scores = wh["hospital_efficiency_scores"].where(F.col("scope_type") == "department")
    return scores.groupBy(F.col("scope_name").alias("department")).agg(
        F.max("efficiency_score").alias("department_efficiency_score")
    )
