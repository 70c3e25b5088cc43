"""The 65 relational analyses (Q01-Q65), each a function of the warehouse.

Rankings cut by a limit carry the key as last sort column, so equal values always give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.functions.columns import mean, month_start, ratio
from wardlens.functions.scale import materialize_small
from wardlens.operators import views
from wardlens.operators.views import Tables

ANALYSES: dict[str, Callable[[Tables], DataFrame]] = {}


def analysis(number: int):
    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        ANALYSES[f"q{number:02d}_{fn.__name__}"] = fn
        return fn

    return register


def _n(name: str) -> Column:
    return F.count("*").alias(name)


def _adm(wh: Tables) -> DataFrame:
    return wh["admissions"]


def _bc(wh: Tables) -> DataFrame:
    return views.billing_claims(wh)


def _department_metric(wh: Tables, metric: str) -> DataFrame:
    return views.department_kpis(wh).select("department", metric).orderBy(F.desc(metric), "department")


@analysis(1)
def executive_kpis(wh: Tables) -> DataFrame:
    return views.executive_kpis(wh)


@analysis(2)
def departments_by_admissions(wh: Tables) -> DataFrame:
    return _department_metric(wh, "admissions")


@analysis(3)
def departments_by_revenue(wh: Tables) -> DataFrame:
    return _department_metric(wh, "revenue")


@analysis(4)
def departments_by_readmission(wh: Tables) -> DataFrame:
    return _department_metric(wh, "readmission_rate")


@analysis(5)
def departments_by_wait(wh: Tables) -> DataFrame:
    return _department_metric(wh, "average_wait")


@analysis(6)
def departments_by_los(wh: Tables) -> DataFrame:
    return _department_metric(wh, "average_los")


@analysis(7)
def doctor_utilization_ranking(wh: Tables) -> DataFrame:
    return views.doctor_utilization(wh).orderBy(F.desc("admissions"), "doctor_id")


def high_readmission_doctors(wh: Tables, min_admissions: int = 100) -> DataFrame:
    return (
        views.doctor_utilization(wh)
        .where(F.col("admissions") >= min_admissions)
        .select("doctor_id", "department", "admissions", "readmission_rate")
        .orderBy(F.desc("readmission_rate"), "doctor_id")
    )


analysis(8)(high_readmission_doctors)


@analysis(9)
def monthly_admissions(wh: Tables) -> DataFrame:
    return _adm(wh).groupBy(month_start(F.col("admit_date")).alias("month_start")).agg(_n("admissions")).orderBy("month_start")


def _quarterly_growth(df: DataFrame, day: str, value: Column, name: str) -> DataFrame:
    quarters = df.groupBy(F.year(day).alias("yr"), F.quarter(day).alias("qtr")).agg(value.alias(name))
    previous = F.lag(name).over(Window.orderBy("yr", "qtr"))
    return quarters.withColumn(f"{name}_growth", F.col(name) - previous)


@analysis(10)
def quarterly_admissions_growth(wh: Tables) -> DataFrame:
    return _quarterly_growth(_adm(wh), "admit_date", F.count("*"), "admissions")


@analysis(11)
def monthly_paid_revenue(wh: Tables) -> DataFrame:
    by_month = views.monthly_revenue(wh).groupBy("month_start")
    return by_month.agg(F.sum("paid_revenue").alias("paid_revenue")).orderBy("month_start")


@analysis(12)
def quarterly_revenue_growth(wh: Tables) -> DataFrame:
    return _quarterly_growth(_bc(wh), "claim_billing_date", F.sum("paid_amount"), "revenue")


@analysis(13)
def claim_success_by_insurer(wh: Tables) -> DataFrame:
    per_payer = _bc(wh).groupBy("insurance_provider")
    return per_payer.agg(mean("claim_approved").alias("approval_ratio"), _n("claims")).orderBy(F.desc("approval_ratio"))


@analysis(14)
def denied_claim_value(wh: Tables) -> DataFrame:
    denied = _bc(wh).where(F.col("claim_status") == "Denied").groupBy("insurance_provider")
    return denied.agg(F.sum("billed_amount").alias("denied_value")).orderBy(F.desc("denied_value"))


@analysis(15)
def payment_method_mix(wh: Tables) -> DataFrame:
    per_method = _bc(wh).groupBy("payment_method")
    return per_method.agg(_n("claims"), F.sum("paid_amount").alias("paid_amount")).orderBy(F.desc("paid_amount"))


@analysis(16)
def average_claim_gap(wh: Tables) -> DataFrame:
    return _bc(wh).groupBy("insurance_provider").agg(mean("claim_gap").alias("avg_gap")).orderBy(F.desc("avg_gap"))


@analysis(17)
def patient_revisit_frequency(wh: Tables) -> DataFrame:
    per_patient = _adm(wh).groupBy("patient_id").agg(_n("visits"))
    return per_patient.where("visits > 1").orderBy(F.desc("visits"), "patient_id")


def _readmission_by(wh: Tables, column: str) -> DataFrame:
    return _adm(wh).groupBy(column).agg(mean("readmitted_30d").alias("readmission_rate"), _n("admissions"))


@analysis(18)
def readmission_by_admit_type(wh: Tables) -> DataFrame:
    return _readmission_by(wh, "admit_type")


@analysis(19)
def readmission_by_ward(wh: Tables) -> DataFrame:
    return _readmission_by(wh, "ward_type")


@analysis(20)
def seven_day_readmission_rate(wh: Tables) -> DataFrame:
    return _adm(wh).agg(mean("readmitted_7d").alias("readmitted_7d_rate"))


@analysis(21)
def bed_occupancy_trend(wh: Tables) -> DataFrame:
    return views.daily_occupancy(wh).orderBy("admit_date")


@analysis(22)
def occupancy_by_weekday(wh: Tables) -> DataFrame:
    days = views.daily_occupancy(wh).groupBy(
        F.dayofweek("admit_date").alias("day_number"), F.date_format("admit_date", "EEEE").alias("day_name")
    )
    averaged = days.agg(F.avg("occupancy_pct").alias("avg_occupancy")).orderBy("day_number")
    return averaged.select("day_name", "avg_occupancy")


@analysis(23)
def peak_waiting_days(wh: Tables) -> DataFrame:
    per_day = _adm(wh).groupBy("admit_date").agg(mean("waiting_time_minutes").alias("avg_wait"))
    return per_day.orderBy(F.desc("avg_wait"), "admit_date").limit(20)


@analysis(24)
def emergency_wait_by_department(wh: Tables) -> DataFrame:
    urgent = _adm(wh).where(F.col("admit_type") == "Emergency").groupBy("department_id")
    return urgent.agg(mean("waiting_time_minutes").alias("emergency_wait")).orderBy(F.desc("emergency_wait"))


@analysis(25)
def los_by_admit_type(wh: Tables) -> DataFrame:
    return _adm(wh).groupBy("admit_type").agg(
        mean("los_days").alias("avg_los"), F.min("los_days").alias("min_los"), F.max("los_days").alias("max_los")
    )


@analysis(26)
def longest_stays(wh: Tables) -> DataFrame:
    stays = _adm(wh).select("patient_id", "admission_id", "los_days")
    return stays.orderBy(F.desc("los_days"), "admission_id").limit(50)


def _with_department(wh: Tables, facts: DataFrame) -> DataFrame:
    """Facts keyed by admission with their department name."""
    keys = _adm(wh).select("admission_id", "department_id")
    return facts.join(keys, "admission_id").join(F.broadcast(wh["departments"]), "department_id")


@analysis(27)
def severity_by_department(wh: Tables) -> DataFrame:
    return (
        _with_department(wh, wh["diagnoses"])
        .groupBy("department")
        .agg(mean("charlson_index").alias("avg_charlson"), mean("disease_severity_score").alias("avg_severity"))
        .orderBy(F.desc("avg_severity"))
    )


@analysis(28)
def lab_abnormality_by_readmission(wh: Tables) -> DataFrame:
    labs = wh["labs"].select("admission_id", "lab_abnormality_score")
    joined = _adm(wh).select("admission_id", "readmitted_30d").join(labs, "admission_id")
    return joined.groupBy("readmitted_30d").agg(mean("lab_abnormality_score").alias("avg_lab_abnormality"))


@analysis(29)
def medicine_usage(wh: Tables) -> DataFrame:
    per_code = wh["medicines"].groupBy("medicine_code")
    return per_code.agg(
        F.sum("medicine_count").alias("total_usage"), mean("average_medicine_cost").alias("avg_cost")
    ).orderBy(F.desc("total_usage"))


@analysis(30)
def procedures_by_department(wh: Tables) -> DataFrame:
    per_department = _with_department(wh, wh["procedures"]).groupBy("department")
    return per_department.agg(F.sum("num_procedures").alias("procedures")).orderBy(F.desc("procedures"))


@analysis(31)
def top_patients_by_revenue(wh: Tables) -> DataFrame:
    per_patient = wh["billing"].groupBy("patient_id").agg(F.sum("paid_amount").alias("revenue"))
    return per_patient.orderBy(F.desc("revenue"), "patient_id").limit(50)


@analysis(32)
def revenue_per_admission(wh: Tables) -> DataFrame:
    per_admission = ratio(F.col("revenue"), F.col("admissions")).alias("revenue_per_admission")
    return views.department_kpis(wh).select("department", per_admission).orderBy(F.desc("revenue_per_admission"))


@analysis(33)
def top_department_ids(wh: Tables) -> DataFrame:
    return _adm(wh).groupBy("department_id").agg(_n("admissions")).orderBy(F.desc("admissions"))


@analysis(34)
def discharge_outcomes(wh: Tables) -> DataFrame:
    return _readmission_by(wh, "discharge_type")


@analysis(35)
def claims_by_status(wh: Tables) -> DataFrame:
    return _bc(wh).groupBy("claim_status").agg(
        _n("claims"), F.sum("billed_amount").alias("billed"), F.sum("paid_amount").alias("paid")
    )


@analysis(36)
def claims_per_day(wh: Tables) -> DataFrame:
    per_day = wh["billing"].groupBy(F.to_date("claim_billing_date").alias("claim_date"))
    return per_day.agg(_n("claims"), F.sum("paid_amount").alias("paid"))


@analysis(37)
def high_risk_departments(wh: Tables) -> DataFrame:
    """Departments above the hospital mean; both levels come from one pass over the admissions."""
    sums = _adm(wh).groupBy("department_id").agg(
        F.sum("readmitted_30d").alias("r"), F.count("readmitted_30d").alias("rn"),
        F.sum("waiting_time_minutes").alias("w"), F.count("waiting_time_minutes").alias("wn"),
    )
    everything = Window.partitionBy()
    hospital = ratio(F.sum("r").over(everything), F.sum("rn").over(everything))
    rated = sums.withColumn("hospital", hospital).withColumn("readmit", ratio(F.col("r"), F.col("rn")))
    return (
        rated.where("readmit > hospital")
        .join(wh["departments"], "department_id")
        .select("department", "readmit", ratio(F.col("w"), F.col("wn")).alias("wait_time"))
        .orderBy(F.desc("wait_time"))
    )


@analysis(38)
def doctor_rank_in_department(wh: Tables) -> DataFrame:
    peers = Window.partitionBy("department").orderBy(F.desc("admissions"))
    doctors = views.doctor_utilization(wh).select("doctor_id", "department", "admissions")
    return doctors.withColumn("department_rank", F.rank().over(peers))


@analysis(39)
def running_admissions(wh: Tables) -> DataFrame:
    daily = _adm(wh).groupBy("admit_date").agg(_n("admissions"))
    running = F.sum("admissions").over(Window.orderBy("admit_date"))
    return daily.withColumn("running_admissions", running).orderBy("admit_date")


@analysis(40)
def running_revenue(wh: Tables) -> DataFrame:
    daily = wh["billing"].groupBy(F.to_date("claim_billing_date").alias("billing_date")).agg(
        F.sum("paid_amount").alias("paid")
    )
    return daily.withColumn("running_revenue", F.sum("paid").over(Window.orderBy("billing_date")))


@analysis(41)
def wait_percentile_in_department(wh: Tables) -> DataFrame:
    """Cumulative distribution from the counts per department and wait value.

    Only eight departments exist, so a window over the admissions would run in eight tasks; the window
    here sees one row per distinct wait, and the shares are joined back on the value.
    """
    counts = _adm(wh).groupBy("department_id", "waiting_time_minutes").agg(F.count("*").alias("n"))
    department = Window.partitionBy("department_id")
    up_to = F.sum("n").over(department.orderBy("waiting_time_minutes"))
    shares = materialize_small(
        counts.withColumn("wait_percentile", ratio(up_to, F.sum("n").over(department))).drop("n"), "wait_shares"
    )
    return (
        _adm(wh)
        .select("department_id", "admission_id", "waiting_time_minutes")
        .join(shares, ["department_id", "waiting_time_minutes"])
        .join(F.broadcast(wh["departments"]), "department_id")
        .select("department", "admission_id", "waiting_time_minutes", "wait_percentile")
    )


@analysis(42)
def multi_risk_patients(wh: Tables) -> DataFrame:
    severity = wh["diagnoses"].select("admission_id", "disease_severity_score")
    joined = _adm(wh).select("admission_id", "patient_id", "readmitted_30d").join(severity, "admission_id")
    per_patient = joined.groupBy("patient_id").agg(
        _n("visits"), mean("disease_severity_score").alias("severity"), mean("readmitted_30d").alias("readmit")
    )
    return per_patient.where("visits > 1 AND severity >= 4").orderBy(F.desc("readmit"), "patient_id")


@analysis(43)
def approval_by_month(wh: Tables) -> DataFrame:
    per_month = _bc(wh).groupBy(month_start(F.col("claim_billing_date")).alias("month_start"))
    return per_month.agg(mean("claim_approved").alias("approval_ratio")).orderBy("month_start")


@analysis(44)
def paid_by_insurer(wh: Tables) -> DataFrame:
    per_payer = _bc(wh).groupBy("insurance_provider")
    return per_payer.agg(mean("paid_amount").alias("avg_paid"), F.sum("paid_amount").alias("total_paid"))


@analysis(45)
def longest_waits(wh: Tables) -> DataFrame:
    waits = _adm(wh).select("admission_id", "patient_id", "waiting_time_minutes")
    return waits.orderBy(F.desc("waiting_time_minutes"), "admission_id").limit(100)


@analysis(46)
def readmission_gaps(wh: Tables) -> DataFrame:
    """Days since the patient's previous discharge.

    The visit number turns the lag into an equality join on (patient, visit), whose keys are unique: no
    task ever holds all visits of one patient.
    """
    visits = wh["model_features"].select("patient_id", "admit_date", "discharge_date", "previous_admissions")
    earlier = visits.select(
        "patient_id",
        F.col("discharge_date").alias("prev_discharge"),
        (F.col("previous_admissions") + 1).alias("previous_admissions"),
    ).where("prev_discharge IS NOT NULL")
    gaps = visits.where("previous_admissions > 0").join(earlier, ["patient_id", "previous_admissions"])
    return gaps.select(
        "patient_id", "admit_date", "prev_discharge", F.datediff("admit_date", "prev_discharge").alias("gap_days")
    ).orderBy("gap_days", "patient_id", "admit_date")


@analysis(47)
def revenue_leakage(wh: Tables) -> DataFrame:
    lost = F.sum(F.col("billed_amount") - F.col("paid_amount")).alias("leakage")
    return _bc(wh).groupBy("insurance_provider").agg(lost).orderBy(F.desc("leakage"))


@analysis(48)
def department_revenue_share(wh: Tables) -> DataFrame:
    share = ratio(F.col("revenue"), F.sum("revenue").over(Window.partitionBy()))
    departments = views.department_kpis(wh).select("department", "revenue")
    return departments.withColumn("revenue_share", share).orderBy(F.desc("revenue_share"))


def _mix(wh: Tables, column: str, share: str) -> DataFrame:
    counts = _adm(wh).groupBy(column).agg(_n("admissions"))
    return counts.withColumn(share, ratio(F.col("admissions"), F.sum("admissions").over(Window.partitionBy())))


@analysis(49)
def admission_mix(wh: Tables) -> DataFrame:
    return _mix(wh, "admit_type", "admission_share")


@analysis(50)
def ward_mix(wh: Tables) -> DataFrame:
    return _mix(wh, "ward_type", "ward_share")


def high_occupancy_days(wh: Tables, alert_pct: float = 90) -> DataFrame:
    days = views.daily_occupancy(wh).select("admit_date", "occupancy_pct")
    return days.where(F.col("occupancy_pct") >= alert_pct).orderBy("admit_date")


analysis(51)(high_occupancy_days)


@analysis(52)
def daily_discharges(wh: Tables) -> DataFrame:
    return _adm(wh).groupBy("discharge_date").agg(_n("discharges")).orderBy("discharge_date")


@analysis(53)
def doctor_revenue_rank(wh: Tables) -> DataFrame:
    doctors = views.doctor_utilization(wh).select("doctor_id", "department", "revenue")
    return doctors.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("revenue"))))


@analysis(54)
def department_wait_gap(wh: Tables) -> DataFrame:
    hospital = _adm(wh).agg(mean("waiting_time_minutes")).scalar()
    departments = views.department_kpis(wh).select("department", "average_wait")
    return departments.withColumn("wait_gap", F.col("average_wait") - hospital).orderBy(F.desc("wait_gap"))


def _by_patient_attribute(wh: Tables, attribute: str) -> DataFrame:
    """Sums per patient before the patient attributes are joined: a frequent patient is one row."""
    per_patient = _adm(wh).groupBy("patient_id").agg(
        _n("visits"), F.sum("readmitted_30d").alias("readmits"), F.count("readmitted_30d").alias("known"),
        F.sum("los_days").alias("days"), F.count("los_days").alias("stays"),
    )
    joined = per_patient.join(wh["patients"].select("patient_id", attribute), "patient_id")
    return joined.groupBy(attribute).agg(
        F.sum("visits").alias("admissions"),
        ratio(F.sum("days"), F.sum("stays")).alias("avg_los"),
        ratio(F.sum("readmits"), F.sum("known")).alias("rate"),
    )


@analysis(55)
def readmission_by_age_group(wh: Tables) -> DataFrame:
    bands = _by_patient_attribute(wh, "age_group")
    return bands.select("age_group", F.col("rate").alias("readmission_rate"), "admissions").orderBy(F.desc("readmission_rate"))


@analysis(56)
def gender_utilization(wh: Tables) -> DataFrame:
    return _by_patient_attribute(wh, "gender").withColumnRenamed("rate", "readmit")


@analysis(57)
def largest_unpaid_claims(wh: Tables) -> DataFrame:
    """The limit is taken on the bills before claims and payers are attached; both are one row per bill."""
    bills = wh["billing"].where("paid_amount = 0").orderBy(F.desc("billed_amount"), "billing_id").limit(100)
    return views.billing_claims({**wh, "billing": bills}).orderBy(F.desc("billed_amount"), "billing_id")


@analysis(58)
def procedures_and_readmission(wh: Tables) -> DataFrame:
    joined = wh["procedures"].join(_adm(wh).select("admission_id", "readmitted_30d"), "admission_id")
    return (
        joined.groupBy("num_procedures")
        .agg(mean("readmitted_30d").alias("readmission_rate"), _n("admissions"))
        .orderBy("num_procedures")
    )


@analysis(59)
def los_bucket_and_paid(wh: Tables) -> DataFrame:
    """Average paid per stay bucket over all bill rows, stays without a bill counting as one unpaid row."""
    paid = wh["billing"].groupBy("admission_id").agg(
        F.count("*").alias("bills"), F.count("paid_amount").alias("priced"), F.sum("paid_amount").alias("paid")
    )
    bucket = F.when(F.col("los_days") <= 2, "Short").when(F.col("los_days") <= 7, "Medium").otherwise("Long")
    stays = _adm(wh).select("admission_id", bucket.alias("los_bucket")).join(paid, "admission_id", "left")
    return stays.groupBy("los_bucket").agg(
        ratio(F.sum("paid"), F.sum("priced")).alias("avg_paid"),
        F.sum(F.coalesce("bills", F.lit(1))).alias("rows_count"),
    )


@analysis(60)
def daily_patient_flow(wh: Tables) -> DataFrame:
    none = F.lit(0).cast("bigint")
    admits = _adm(wh).groupBy(F.col("admit_date").alias("flow_date")).agg(
        _n("admits"), F.max(none).alias("discharges")
    )
    discharges = _adm(wh).groupBy(F.col("discharge_date").alias("flow_date")).agg(
        F.max(none).alias("admits"), _n("discharges")
    )
    both = admits.unionByName(discharges).groupBy("flow_date")
    return both.agg(F.sum("admits").alias("admits"), F.sum("discharges").alias("discharges")).orderBy("flow_date")


@analysis(61)
def command_center_snapshot(wh: Tables) -> DataFrame:
    return views.command_center(wh)


@analysis(62)
def department_efficiency(wh: Tables) -> DataFrame:
    return (
        views.efficiency_ranking(wh)
        .where(F.col("scope_type") == "department")
        .select(
            F.col("scope_name").alias("department"), "efficiency_score", "patient_outcome_score",
            "capacity_balance_score", "patient_flow_score", "efficiency_rank",
        )
        .orderBy("efficiency_rank")
    )


@analysis(63)
def next_week_emergency(wh: Tables) -> DataFrame:
    return wh["emergency_forecast"].select(
        "forecast_date", "forecast_emergency_patients", "method", "provenance"
    ).orderBy("forecast_date")


@analysis(64)
def recommendation_queue(wh: Tables) -> DataFrame:
    return views.operational_action_queue(wh).orderBy("priority_order", "title").drop("priority_order")


def weak_efficiency_components(wh: Tables, below: float = 70) -> DataFrame:
    named = wh["hospital_efficiency_scores"].select(
        "scope_type", "scope_name",
        F.col("patient_outcome_score").alias("Patient outcomes"),
        F.col("capacity_balance_score").alias("Capacity balance"),
        F.col("patient_flow_score").alias("Patient flow"),
    )
    parts = named.unpivot(
        ["scope_type", "scope_name"], ["Patient outcomes", "Capacity balance", "Patient flow"], "component", "score"
    )
    return parts.where(F.col("score") < below).orderBy("score")


analysis(65)(weak_efficiency_components)
