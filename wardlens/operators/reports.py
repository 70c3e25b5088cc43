"""Aggregates behind the dashboard, the executive report and the notebooks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.config import CONFIG, DOCTOR_NAMES, WEEKDAYS
from wardlens.functions.columns import clip, half_even, mean, pick, ratio
from wardlens.functions.scale import beside, exact_quantiles, materialize_small
from wardlens.operators import marts

Tables = Mapping[str, DataFrame]


def _months(df: DataFrame, day: str) -> DataFrame:
    """Every month between the first and the last dated row."""
    span = df.agg(F.trunc(F.min(day), "month").alias("lo"), F.trunc(F.max(day), "month").alias("hi"))
    return span.where("lo IS NOT NULL").select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month_start")
    )


def monthly_activity(feat: DataFrame) -> DataFrame:
    """Admissions, patients, readmission and stay per month; empty months appear with zero counts."""
    by_month = feat.groupBy(F.trunc("admit_date", "month").alias("month_start")).agg(
        F.count("admission_id").alias("n"),
        F.countDistinct("patient_id").alias("p"),
        mean("readmitted_30d").alias("readmission_rate"),
        mean("los_days").alias("average_los"),
    )
    return (
        _months(feat, "admit_date")
        .join(by_month, "month_start", "left")
        .select(
            "month_start",
            F.coalesce("n", F.lit(0)).alias("admissions"),
            F.coalesce("p", F.lit(0)).alias("patients"),
            "readmission_rate",
            "average_los",
        )
        .orderBy("month_start")
    )


def admission_growth(monthly: DataFrame) -> DataFrame:
    """Growth in percent of the last month over the one before."""
    last_two = monthly.orderBy(F.desc("month_start")).limit(2)
    pair = last_two.agg(F.max_by("admissions", "month_start").alias("latest"), F.min_by("admissions", "month_start").alias("previous"))
    return pair.select(((F.col("latest") / F.greatest("previous", F.lit(1)) - 1) * 100).alias("admission_growth"))


def monthly_finance(bill: DataFrame) -> DataFrame:
    dated = bill.where("claim_billing_date IS NOT NULL")
    sums = dated.groupBy(F.trunc("claim_billing_date", "month").alias("month_start")).agg(
        F.sum("billed_amount").alias("b"), F.sum("paid_amount").alias("p")
    )
    zero = F.lit(0).cast("decimal(24,2)")
    return (
        _months(dated, "claim_billing_date")
        .join(sums, "month_start", "left")
        .select("month_start", F.coalesce("b", zero).alias("billed"), F.coalesce("p", zero).alias("paid"))
        .orderBy("month_start")
    )


def yearly_trend(feat: DataFrame) -> DataFrame:
    """Yearly level with growth of admissions and change of the readmission rate over the previous year."""
    years = feat.groupBy(F.year("admit_date").alias("year")).agg(
        F.count("admission_id").alias("admissions"),
        mean("readmitted_30d").alias("readmission_rate"),
        mean("los_days").alias("average_los"),
    )
    order = Window.orderBy("year")
    return years.withColumn(
        "admission_delta", F.col("admissions") / F.lag("admissions").over(order) - 1
    ).withColumn("readmission_delta", F.col("readmission_rate") - F.lag("readmission_rate").over(order))


def ward_summary(feat: DataFrame) -> DataFrame:
    return (
        feat.groupBy("ward_type")
        .agg(
            F.count("admission_id").alias("admissions"),
            F.sum("readmitted_30d").cast("bigint").alias("readmissions"),
            mean("readmitted_30d").alias("readmission_rate"),
            mean("los_days").alias("average_los"),
            mean("bed_utilization_score").alias("utilization"),
        )
        .orderBy("readmission_rate", "ward_type")
    )


def admit_type_summary(feat: DataFrame) -> DataFrame:
    groups = feat.groupBy("admit_type")
    return groups.agg(
        F.count("admission_id").alias("admissions"), mean("readmitted_30d").alias("readmission_rate")
    ).orderBy("readmission_rate", "admit_type")


def payer_summary(bill: DataFrame, insurance: DataFrame, claims: DataFrame) -> DataFrame:
    """Per payer; bills and claims meet on the billing id both are bucketed by."""
    approvals = claims.select("billing_id", "claim_approved")
    per_payer = (
        bill.join(insurance, "insurance_id", "left")
        .join(approvals, "billing_id", "left")
        .groupBy("insurance_provider")
        .agg(
            F.count("billing_id").alias("claims"),
            F.sum("billed_amount").alias("billed"),
            F.sum("paid_amount").alias("paid"),
            F.sum("claim_gap").alias("gap"),
            mean("claim_approved").alias("approval"),
        )
    )
    return per_payer.withColumn("collection_rate", ratio(F.col("paid"), F.col("billed"))).orderBy("paid")


def claim_status_counts(claims: DataFrame) -> DataFrame:
    return claims.groupBy("claim_status").agg(F.count("*").alias("claims")).orderBy(F.desc("claims"), "claim_status")


def finance_totals(bill: DataFrame, claims: DataFrame) -> DataFrame:
    money = bill.agg(
        F.sum("billed_amount").alias("billed"), F.sum("paid_amount").alias("paid"), F.sum("claim_gap").alias("gap")
    )
    return beside(money, claims.agg(mean("claim_approved").alias("approval_rate"))).withColumn(
        "collection_rate", ratio(F.col("paid"), F.col("billed"))
    )


def rolling_admissions(monthly: DataFrame, months: int = 24, width: int = 3) -> DataFrame:
    """Latest months with the trailing mean, empty until ``width`` months are available."""
    recent = monthly.orderBy(F.desc("month_start")).limit(months).select("month_start", "admissions")
    frame = Window.orderBy("month_start").rowsBetween(1 - width, 0)
    trailing = F.when(F.count("admissions").over(frame) == width, F.avg("admissions").over(frame))
    return recent.withColumn(f"rolling_{width}m", trailing).orderBy("month_start")


def _p75(feat: DataFrame, column: str) -> Column:
    return F.lit(exact_quantiles(feat, {column: [0.75]})[column][0])


def high_complexity_cohort(feat: DataFrame) -> DataFrame:
    p75 = _p75(feat, "patient_complexity_index")
    cohort = feat.where(F.col("patient_complexity_index") >= p75)
    return cohort.agg(
        F.count("*").alias("admissions"), mean("readmitted_30d").alias("readmission_rate")
    ).withColumn("threshold", p75)


def department_performance(feat: DataFrame) -> DataFrame:
    """Department summary with revenue, stay and success rate."""
    return (
        feat.groupBy("department")
        .agg(
            F.countDistinct("patient_id").alias("patients"),
            F.count("admission_id").alias("admissions"),
            F.sum("revenue_per_patient").alias("revenue"),
            mean("los_days").alias("average_los"),
            mean("waiting_time_minutes").alias("average_wait"),
            mean("readmitted_30d").alias("readmission_rate"),
            mean("bed_utilization_score").alias("bed_utilization"),
        )
        .withColumn("success_rate", 1 - F.col("readmission_rate"))
    )


HEATMAP_METRICS = ("admissions", "revenue", "average_los", "average_wait", "success_rate")


def department_heatmap(dep: DataFrame) -> DataFrame:
    """Metrics scaled to 0-1 over the departments; a metric without spread has no scale."""
    everything = Window.partitionBy()

    def scaled(c: str) -> Column:
        value = F.col(c).cast("double")
        low, high = F.min(value).over(everything), F.max(value).over(everything)
        return ratio(value - low, high - low).alias(c)

    return dep.select("department", *[scaled(c) for c in HEATMAP_METRICS])


def doctor_alias(doctor_id: Column) -> Column:
    """Display name from the digits of the id: list position modulo ten, team number from the quotient."""
    digits = F.regexp_replace(doctor_id, "[^0-9]", "")
    index = F.when(digits == "", F.lit(0)).otherwise(digits.try_cast("bigint") - 1)
    names = F.array(*[F.lit(n) for n in DOCTOR_NAMES])
    size = len(DOCTOR_NAMES)
    name = F.element_at(names, (F.pmod(index, F.lit(size)) + 1).cast("int"))
    team = F.floor(index / size) + 1
    return F.concat(name, F.lit(" · Team "), team.cast("string"))


def average_rank_share(column: str) -> Column:
    """Average rank of tied values divided by the row count."""
    ties = Window.partitionBy(column)
    return (F.rank().over(Window.orderBy(column)) + (F.count("*").over(ties) - 1) / 2) / F.count("*").over(Window.partitionBy())


def doctor_performance(feat: DataFrame) -> DataFrame:
    """One row per doctor; the rank windows run over the doctors, not the admissions."""
    doctors = feat.groupBy("doctor_id", "department").agg(
        F.countDistinct("patient_id").alias("patients"),
        F.count("admission_id").alias("admissions"),
        mean("los_days").alias("average_treatment_days"),
        F.sum("revenue_per_patient").alias("revenue"),
        mean("waiting_time_minutes").alias("average_wait"),
        mean("readmitted_30d").alias("readmission_rate"),
    )
    wait = 1 - average_rank_share("average_wait")
    outcome = 1 - average_rank_share("readmission_rate")
    return (
        doctors.withColumn("doctor", doctor_alias(F.col("doctor_id")))
        .withColumn("wait_score", wait)
        .withColumn("outcome_score", outcome)
        .withColumn("quality_score", half_even((F.col("wait_score") + F.col("outcome_score")) / 2 * 100, 1))
        .drop("wait_score", "outcome_score")
    )


def doctor_leaderboard(
    doctors: DataFrame, k: int = 12, by: str = "quality_score", departments: Sequence[str] | None = None
) -> DataFrame:
    chosen = doctors if departments is None else doctors.where(F.col("department").isin(*departments))
    return chosen.orderBy(F.desc(by), "doctor_id").limit(k)


def patient_search(feat: DataFrame, text: str = "", limit: int = 1000) -> DataFrame:
    """Distinct patient ids containing the text in any case; the limit is the size of the pick list."""
    needle = text.strip().lower()
    ids = feat.select("patient_id")
    if needle:
        ids = ids.where(F.lower("patient_id").contains(needle))
    return ids.distinct().orderBy("patient_id").limit(limit)


def patient_timeline(feat: DataFrame, patient_id: str) -> DataFrame:
    """Visits of one patient; the encounter number is the stored visit number, so nothing is ranked here."""
    number = (F.col("previous_admissions") + 1).cast("string")
    return (
        feat.where(F.col("patient_id") == patient_id)
        .select(
            F.concat(F.lit("Encounter "), number).alias("encounter"),
            "admit_date", "discharge_date", "department", "admit_type", "los_days", "disease_severity_score",
            "readmitted_30d", "previous_admissions",
        )
        .orderBy("previous_admissions")
        .drop("previous_admissions")
    )


LATEST_COLUMNS = (
    "admission_id", "admit_date", "discharge_date", "department", "ward_type", "los_days",
    "disease_severity_score", "lab_abnormality_score", "readmitted_30d", "risk_score",
)


def latest_encounter(feat: DataFrame) -> DataFrame:
    """Last visit of every patient with the mean stay of its ward.

    The latest row is a maximum, combined before the shuffle: a frequent patient costs one row per task.
    """
    visit = F.struct("previous_admissions", *LATEST_COLUMNS)
    latest = feat.groupBy("patient_id").agg(F.max(visit).alias("v")).select("patient_id", "v.*").drop("previous_admissions")
    # Written, so that its real size decides whether it is broadcast to the patients.
    wards = materialize_small(feat.groupBy("ward_type").agg(mean("los_days").alias("ward_average_los")), "ward_means")
    return latest.join(wards, "ward_type", "left")


def risk_class(feat: DataFrame) -> DataFrame:
    median, p75 = exact_quantiles(feat, {"risk_score": [0.5, 0.75]})["risk_score"]
    score = F.col("risk_score")
    label = F.when(score >= F.lit(p75), "HIGH").when(score >= F.lit(median), "MEDIUM").otherwise("LOW")
    return feat.select("admission_id", "patient_id", "risk_score", label.alias("risk_class"))


def risk_segmentation(feat: DataFrame) -> DataFrame:
    """Counts in three right-closed quantile bins. Edges that coincide would merge bins, which the labels forbid."""
    low, first, second, high = exact_quantiles(feat, {"risk_score": [0.0, 1 / 3, 2 / 3, 1.0]})["risk_score"]
    if len({low, first, second, high}) < 4:
        raise ValueError("risk scores do not spread over three bins")
    score = F.col("risk_score")
    group = F.when(score <= F.lit(first), "Low").when(score <= F.lit(second), "Medium").otherwise("High")
    known = feat.where("risk_score IS NOT NULL")
    return known.groupBy(group.alias("risk_group")).agg(F.count("*").alias("patients"))


def patient_flow_funnel(feat: DataFrame) -> DataFrame:
    p75 = _p75(feat, "patient_complexity_index")
    stages = feat.agg(
        F.count("*").alias("Admissions"),
        F.countDistinct("patient_id").alias("Unique patients"),
        F.count_if(F.col("patient_complexity_index") >= p75).alias("High-complexity encounters"),
        F.sum("readmitted_30d").cast("bigint").alias("30-day readmissions"),
    )
    return stages.unpivot([], list(stages.columns), "stage", "volume")


def age_histogram(feat: DataFrame, bins: int = 18) -> DataFrame:
    """Equal-width bins between the youngest and the oldest age, last bin closed, counted per gender."""
    by_age = feat.groupBy("age", "gender").agg(F.count("*").alias("n"))
    everything = Window.partitionBy()  # one row per age and gender
    position = F.floor(F.try_divide((F.col("age") - F.col("lo")) * bins, F.col("hi") - F.col("lo")))
    bin_no = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (
        by_age.withColumn("lo", F.min("age").over(everything))
        .withColumn("hi", F.max("age").over(everything))
        .withColumn("bin", bin_no)
        .groupBy("bin", "gender", (F.col("lo") + F.col("bin") * width).alias("age_from"))
        .agg(F.sum("n").alias("patients"))
        .orderBy("bin", "gender")
    )


def weekday_volume(feat: DataFrame) -> DataFrame:
    """Admissions from Monday to Sunday; a weekday without admissions has no value."""
    number = F.col("id").cast("int")
    days = feat.sparkSession.range(0, len(WEEKDAYS), 1, 1).select(
        number.alias("day_number"), pick(WEEKDAYS, number).alias("weekday")
    )
    counts = feat.groupBy(F.weekday("admit_date").alias("day_number")).agg(F.count("*").alias("admissions"))
    return days.join(counts, "day_number", "left").orderBy("day_number")


RISK_FACTORS = (
    "los_days", "charlson_index", "previous_admissions", "lab_abnormality_score", "patient_complexity_index",
)


def risk_comparison(feat: DataFrame) -> DataFrame:
    """Feature means with one column per readmission outcome."""
    means = feat.groupBy("readmitted_30d").agg(*[mean(c).alias(c) for c in RISK_FACTORS])
    long = means.unpivot(["readmitted_30d"], list(RISK_FACTORS), "feature", "value")
    return (
        long.groupBy("feature")
        .pivot("readmitted_30d", [0.0, 1.0])
        .agg(F.first("value"))
        .toDF("feature", "not_readmitted", "readmitted")
    )


CORRELATED = (
    "readmitted_30d", "los_days", "charlson_index", "previous_admissions", "lab_abnormality_score",
    "patient_complexity_index", "waiting_time_minutes", "revenue_per_patient",
)


def correlation_matrix(feat: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """Pearson matrix in long form: each pair is computed once, in one pass, and mirrored."""
    values = feat.select(*[F.col(c).cast("double").alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = values.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        value = F.col(f"{a}|{b}")
        for row, col in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(row).alias("feature"), F.lit(col).alias("other"), value.alias("correlation")))
    return one.select(F.inline(F.array(*cells)))


def bed_status(history: DataFrame, capacity: int = CONFIG.bed_capacity) -> DataFrame:
    """Mean beds of the last week, free beds, occupancy and the trailing 30-day mean percentage."""
    week = history.orderBy(F.desc("date")).limit(7).agg(half_even(F.avg("occupied_beds")).cast("bigint").alias("current_beds"))
    month = history.orderBy(F.desc("date")).limit(30).agg(F.avg("occupancy_pct").alias("mean_pct_30d"))
    return beside(week, month).select(
        "current_beds",
        F.greatest(F.lit(capacity) - F.col("current_beds"), F.lit(0)).alias("available_beds"),
        F.least(F.col("current_beds") / F.lit(float(capacity)), F.lit(1.0)).alias("occupancy_rate"),
        "mean_pct_30d",
    )


def trailing_occupancy(history: DataFrame, days: int = 365) -> DataFrame:
    return history.orderBy(F.desc("date")).limit(days).orderBy("date")


def department_bed_pressure(feat: DataFrame) -> DataFrame:
    pressure = feat.groupBy("department").agg(mean("bed_utilization_score").alias("bed_utilization_score"))
    return pressure.orderBy("bed_utilization_score")


def forecast_horizon(forecast: DataFrame, days: int = 30, capacity: int = CONFIG.bed_capacity) -> DataFrame:
    """The first ``days`` days of every series' forecast."""
    shown = clip(F.col("forecast_occupied_beds") / F.lit(float(capacity)) * 100, 0, 100)
    opening = forecast.groupBy("series").agg(F.min("forecast_date").alias("opening"))
    within = forecast.join(opening, "series").where(F.col("forecast_date") < F.date_add("opening", days))
    return within.drop("opening").withColumn("display_occupancy_pct", shown)


def revenue_long(monthly: DataFrame) -> DataFrame:
    return monthly.unpivot(["month_start"], ["billed", "paid"], "measure", "amount")


def icu_weekend_share(feat: DataFrame) -> DataFrame:
    icu = feat.where(F.upper("ward_type") == "ICU")
    return icu.agg(
        F.count("*").alias("icu_admissions"),
        F.coalesce(mean("is_weekend_admission"), F.lit(0.0)).alias("weekend_share"),
    )


def top_department_contribution(dep: DataFrame) -> DataFrame:
    """Revenue leader with its share, busiest department and longest wait, first name on ties."""

    def lead(metric: str, name: str) -> Column:
        order = F.struct((-F.col(metric).cast("double")).alias("v"), F.col("department").alias("d"))
        return F.min(order).alias(name)

    best = dep.agg(
        lead("revenue", "by_revenue"), lead("admissions", "by_volume"), lead("average_wait", "by_wait"),
        F.sum("revenue").cast("double").alias("total"),
    )
    return best.select(
        F.col("by_revenue.d").alias("revenue_leader"),
        ratio(-F.col("by_revenue.v"), F.col("total")).alias("revenue_share"),
        F.col("by_volume.d").alias("busiest_department"),
        F.col("by_wait.d").alias("longest_wait_department"),
        (-F.col("by_wait.v")).alias("longest_wait"),
    )


def department_forecast(predictions: DataFrame) -> DataFrame:
    """Actual and predicted revenue per department."""
    return predictions.groupBy("department").agg(
        F.sum("actual").alias("actual_revenue"), F.sum("prediction").alias("predicted_revenue")
    )


def planned_revenue_daily(predictions: DataFrame) -> DataFrame:
    planned = F.greatest(F.col("prediction"), F.lit(0.0))
    return predictions.groupBy("admit_date").agg(F.sum(planned).alias("predicted_revenue")).orderBy("admit_date")


def planned_revenue_monthly(daily: DataFrame) -> DataFrame:
    sums = daily.groupBy(F.trunc("admit_date", "month").alias("month_start")).agg(F.sum("predicted_revenue").alias("s"))
    return (
        _months(daily, "admit_date")
        .join(sums, "month_start", "left")
        .select("month_start", F.coalesce("s", F.lit(0.0)).alias("predicted_revenue"))
        .orderBy("month_start")
    )


def current_census(feat: DataFrame, capacity: int = CONFIG.bed_capacity) -> DataFrame:
    """Bed status straight from the features."""
    return bed_status(marts.historical_occupancy(feat, capacity), capacity)
