"""Analytical views (V1-V11) and parameterised reports (P1-P3) over a warehouse."""

from __future__ import annotations

import calendar
from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.config import CONFIG
from wardlens.functions.columns import month_start, ratio
from wardlens.functions.scale import beside, left_join_salted
from wardlens.operators.ledgers import VISIT_MONTH, visit_rows

Tables = Mapping[str, DataFrame]


def _claims_per_bill(wh: Tables) -> DataFrame:
    return wh["claims"].groupBy("billing_id").agg(
        F.count("*").alias("claim_rows"),
        F.count("claim_approved").alias("rated"),
        F.sum("claim_approved").alias("approved"),
    )


def _bills_per_admission(wh: Tables, with_claims: bool = False) -> DataFrame:
    """What the bill join would add to each admission, combined before it is joined.

    ``fan`` is the number of joined rows, so weighted averages equal those over the fanned-out join,
    while a heavily billed admission never becomes a heavy join key.
    """
    if getattr(wh, "bill_sums", None) is not None:
        return wh.bill_sums.select("admission_id", "fan", "paid", "rated", "approved")
    bills = wh["billing"].select("billing_id", "admission_id", "paid_amount")
    if not with_claims:
        return bills.groupBy("admission_id").agg(F.count("*").alias("fan"), F.sum("paid_amount").alias("paid"))
    joined = bills.join(_claims_per_bill(wh), "billing_id", "left")
    copies = F.coalesce("claim_rows", F.lit(1))
    return joined.groupBy("admission_id").agg(
        F.sum(copies).alias("fan"),
        F.sum(F.col("paid_amount") * copies).cast("decimal(28,2)").alias("paid"),
        F.sum("rated").alias("rated"),
        F.sum("approved").alias("approved"),
    )


def _billed_admissions(wh: Tables, with_claims: bool = False) -> DataFrame:
    return wh["admissions"].join(_bills_per_admission(wh, with_claims), "admission_id", "left").withColumn(
        "fan", F.coalesce("fan", F.lit(1))
    )


def _fan_mean(column: str) -> Column:
    value = F.col(column)
    return ratio(F.sum(value * F.col("fan")), F.sum(F.when(value.isNotNull(), F.col("fan"))))


def _paid_total() -> Column:
    return F.coalesce(F.sum("paid"), F.lit(0)).cast("decimal(28,2)")


def executive_kpis(wh: Tables) -> DataFrame:
    return _billed_admissions(wh, with_claims=True).agg(
        F.count("admission_id").alias("admissions"),
        F.countDistinct("patient_id").alias("patients"),
        _fan_mean("readmitted_30d").alias("readmission_rate"),
        _fan_mean("los_days").alias("average_los"),
        _fan_mean("waiting_time_minutes").alias("average_waiting_time"),
        _paid_total().alias("paid_revenue"),
        ratio(F.sum("approved"), F.sum("rated")).alias("claim_approval_ratio"),
    )


def command_center(wh: Tables) -> DataFrame:
    """One snapshot row beside one outlook row."""
    outlook = wh["operational_forecast_summary"].select(
        "forecast_start_date", "forecast_end_date",
        F.col("emergency_patients").alias("next_week_emergency_patients"),
        "emergency_growth_pct", "additional_beds", "peak_day", "peak_day_volume", "peak_hour_status",
    )
    return beside(wh["command_center_kpis"].drop("snapshot_provenance"), outlook)


def efficiency_ranking(wh: Tables) -> DataFrame:
    by_scope = Window.partitionBy("scope_type").orderBy(F.desc("efficiency_score"))
    return wh["hospital_efficiency_scores"].withColumn("efficiency_rank", F.dense_rank().over(by_scope))


def operational_action_queue(wh: Tables) -> DataFrame:
    order = F.when(F.col("priority") == "P1", 1).when(F.col("priority") == "P2", 2).otherwise(3)
    return wh["operational_recommendations"].withColumn("priority_order", order)


def department_kpis(wh: Tables) -> DataFrame:
    per_id = _billed_admissions(wh).groupBy("department_id").agg(
        F.count("admission_id").alias("admissions"),
        F.countDistinct("patient_id").alias("patients"),
        _fan_mean("readmitted_30d").alias("readmission_rate"),
        _fan_mean("los_days").alias("average_los"),
        _fan_mean("waiting_time_minutes").alias("average_wait"),
        _paid_total().alias("revenue"),
    )
    ranked = Window.orderBy(F.desc("revenue"))
    return (
        wh["departments"]
        .join(per_id, "department_id", "left")
        .select(
            "department",
            F.coalesce("admissions", F.lit(0)).alias("admissions"),
            F.coalesce("patients", F.lit(0)).alias("patients"),
            "readmission_rate", "average_los", "average_wait",
            F.coalesce("revenue", F.lit(0)).cast("decimal(28,2)").alias("revenue"),
        )
        .withColumn("revenue_rank", F.dense_rank().over(ranked))
    )


def doctor_utilization(wh: Tables) -> DataFrame:
    per_doctor = _billed_admissions(wh).groupBy("doctor_id").agg(
        F.count("admission_id").alias("admissions"),
        F.countDistinct("patient_id").alias("patients"),
        _fan_mean("waiting_time_minutes").alias("avg_wait"),
        _fan_mean("readmitted_30d").alias("readmission_rate"),
        _paid_total().alias("revenue"),
    )
    peers = Window.partitionBy("department").orderBy("admissions")
    return (
        wh["doctors"]
        .select("doctor_id", "department")
        .join(per_doctor, "doctor_id", "left")
        .select(
            "doctor_id", "department",
            F.coalesce("admissions", F.lit(0)).alias("admissions"),
            F.coalesce("patients", F.lit(0)).alias("patients"),
            "avg_wait", "readmission_rate",
            F.coalesce("revenue", F.lit(0)).cast("decimal(28,2)").alias("revenue"),
        )
        .withColumn("workload_percentile", F.percent_rank().over(peers))
    )


def billing_claims(wh: Tables) -> DataFrame:
    """Flat bills with payer and claim: one scan of the bills they were projected from, where these are known."""
    names = (
        "billing_id", "patient_id", "encounter_id", "insurance_provider", "payment_method", "claim_id",
        "claim_billing_date", "billed_amount", "paid_amount", "claim_status", "claim_gap", "claim_approved",
    )
    if getattr(wh, "bill_lines", None) is not None:
        claim = F.coalesce("claim_id", F.concat(F.lit("NOCLAIM-"), "billing_id"))
        return wh.bill_lines.withColumn("encounter_id", F.col("admission_id")).withColumn("claim_id", claim).select(*names)
    bills = wh["billing"].alias("b")
    payers = wh["insurance"].alias("i")
    lines = wh["claims"].select("billing_id", "claim_id", "claim_status", "claim_approved")
    return (
        bills.join(payers, "insurance_id", "left")
        .join(lines, "billing_id", "left")
        .select(
            "billing_id", "patient_id", F.col("admission_id").alias("encounter_id"), "insurance_provider",
            "payment_method", "claim_id", "claim_billing_date", "billed_amount", "paid_amount", "claim_status",
            "claim_gap", "claim_approved",
        )
    )


def monthly_revenue(wh: Tables) -> DataFrame:
    by_month = (
        billing_claims(wh)
        .groupBy(month_start(F.col("claim_billing_date")).alias("month_start"), "insurance_provider")
        .agg(
            F.sum("billed_amount").alias("billed_revenue"),
            F.sum("paid_amount").alias("paid_revenue"),
            ratio(F.sum("claim_approved"), F.count("claim_approved")).alias("claim_approval_ratio"),
        )
    )
    previous = F.lag("paid_revenue").over(Window.partitionBy("insurance_provider").orderBy("month_start"))
    return by_month.withColumn("month_over_month_change", F.col("paid_revenue") - previous)


def daily_occupancy(wh: Tables, capacity: int = CONFIG.bed_capacity) -> DataFrame:
    """Beds in use on every observed admission day, by sweeping arrivals and departures.

    Each stay adds one at admission and removes one the day after discharge. Days are combined before the
    running sum, so the sweep sees one row per calendar day. A stay that ends before it starts covers no day.
    """
    stays = wh["admissions"].select("admit_date", "discharge_date").where("admit_date IS NOT NULL")
    arrivals = stays.groupBy(F.col("admit_date").alias("day")).agg(
        F.count("*").alias("admissions"),
        F.count_if(F.coalesce(F.col("discharge_date") >= F.col("admit_date"), F.lit(True))).alias("change"),
    )
    departures = (
        stays.where(F.col("discharge_date") >= F.col("admit_date"))
        .groupBy(F.date_add("discharge_date", 1).alias("day"))
        .agg(F.lit(0).cast("bigint").alias("admissions"), (-F.count("*")).alias("change"))
    )
    days = arrivals.unionByName(departures).groupBy("day").agg(
        F.sum("admissions").alias("admissions"), F.sum("change").alias("change")
    )
    order = Window.orderBy("day")
    sweep = days.withColumn("occupied_beds", F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return sweep.where("admissions > 0").select(
        F.col("day").alias("admit_date"),
        "admissions",
        "occupied_beds",
        F.least(F.lit(100.0), F.col("occupied_beds") * 100 / F.lit(float(capacity))).alias("occupancy_pct"),
        F.avg("occupied_beds").over(order.rowsBetween(-6, 0)).alias("occupied_beds_7d_avg"),
    )


def bed_occupancy(wh: Tables) -> DataFrame:
    return daily_occupancy(wh)


P360_COLUMNS = (
    "patient_id", "age", "gender", "admission_id", "admit_date", "discharge_date", "department", "doctor_id",
    "disease_severity_score", "lab_abnormality_score", "medicine_code", "medicine_count", "billed_amount",
    "paid_amount", "claim_status",
)


def _visits(wh: Tables, people: DataFrame) -> DataFrame:
    """Patients with their visits from the tables, for a warehouse whose tables were replaced."""
    visits = (
        wh["admissions"].select("patient_id", "admission_id", "admit_date", "discharge_date", "department_id", "doctor_id")
        .join(wh["departments"], "department_id", "left")
        .join(wh["doctors"].select("doctor_id", F.col("doctor_id").alias("known_doctor")), "doctor_id", "left")
        .withColumn("doctor_id", F.col("known_doctor"))
        .join(wh["diagnoses"].select("admission_id", "disease_severity_score"), "admission_id", "left")
        .join(wh["labs"].select("admission_id", "lab_abnormality_score"), "admission_id", "left")
        .join(wh["medicines"].select("admission_id", "medicine_code", "medicine_count"), "admission_id", "left")
        .drop("department_id", "known_doctor")
    )
    return left_join_salted(people, visits, "patient_id")


def _money(wh: Tables) -> DataFrame:
    """Bills with the status of their claim."""
    if getattr(wh, "bill_lines", None) is not None:
        return wh.bill_lines.select("billing_id", "admission_id", "billed_amount", "paid_amount", "claim_status")
    return wh["billing"].select("billing_id", "admission_id", "billed_amount", "paid_amount").join(
        wh["claims"].select("billing_id", "claim_status"), "billing_id", "left"
    )


def patient_360(wh: Tables, patient_id: str | None = None) -> DataFrame:
    """Every patient with admissions, clinical facts, bills and claims; newest first for one patient.

    Visits and bills are read once each: the features hold all that a visit shows, and a very frequently billed
    admission is spread over tasks. One patient's report reads the stored ledgers, where months and row groups without the
    patient are skipped.
    """
    if patient_id is not None and getattr(wh, "ledgers", None) is not None:
        visits, bills = (ledger.where(F.col("patient_id") == patient_id) for ledger in wh.ledgers)
        money = bills.select("admission_id", "billed_amount", "paid_amount", "claim_status")
        return visits.join(money, "admission_id", "left").select(*P360_COLUMNS).orderBy(F.desc("admit_date"), "admission_id")
    if getattr(wh, "visit_lines", None) is not None:
        visits = visit_rows(wh.visit_lines)
    else:
        people = wh["patients"].select("patient_id", "age", "gender")
        visits = _visits(wh, people)
    if patient_id is not None:
        visits = visits.where(F.col("patient_id") == patient_id)
    sums = getattr(wh, "bill_sums", None)
    sizes = sums.select("admission_id", F.col("fan").alias("n")) if sums is not None else None
    rows = left_join_salted(visits, _money(wh), "admission_id", sizes).select(*P360_COLUMNS)
    return rows if patient_id is None else rows.orderBy(F.desc("admit_date"), "admission_id")


def monthly_operations_report(wh: Tables, year: int, month: int) -> DataFrame:
    """Department table of one month: that month's folder of the visit ledger, where there is one."""
    if getattr(wh, "ledgers", None) is not None:
        chosen = wh.ledgers[0].where((F.col(VISIT_MONTH) == year * 100 + month) & F.col("department_id").isNotNull())
    else:
        first = date(year, month, 1)
        last = date(year, month, calendar.monthrange(year, month)[1])
        admitted = wh["admissions"].where(F.col("admit_date").between(F.lit(first), F.lit(last)))
        bills = wh["billing"].select("admission_id", "paid_amount").join(
            admitted.select("admission_id"), "admission_id", "left_semi"
        )
        paid = bills.groupBy("admission_id").agg(F.count("*").alias("fan"), F.sum("paid_amount").alias("paid"))
        chosen = admitted.join(paid, "admission_id", "left").join(F.broadcast(wh["departments"]), "department_id")
    return (
        chosen.withColumn("fan", F.coalesce("fan", F.lit(1)))
        .groupBy("department")
        .agg(
            F.count("admission_id").alias("admissions"),
            _fan_mean("los_days").alias("avg_los"),
            _fan_mean("waiting_time_minutes").alias("avg_wait"),
            _fan_mean("readmitted_30d").alias("readmission_rate"),
            _paid_total().alias("revenue"),
        )
        .orderBy(F.desc("revenue"), "department")
    )


def command_center_report(wh: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Snapshot with outlook, ranked scores and the action queue."""
    return (
        command_center(wh),
        efficiency_ranking(wh).orderBy("scope_type", "efficiency_rank"),
        operational_action_queue(wh).orderBy("priority_order", "title"),
    )
