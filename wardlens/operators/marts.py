"""Decision marts: census, snapshot, efficiency, forecasts and recommendations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from wardlens.config import CONFIG, OpsConfig, SURROGATE_LINK
from wardlens.functions.columns import clip, half_even, mean, percent_text, ratio
from wardlens.functions.scale import beside, exact_quantiles

FORECAST_DAYS = 7
BASELINE_DAYS = 56


def day_span(feat: DataFrame) -> DataFrame:
    """First and last admission day, one row."""
    return feat.agg(F.min("admit_date").alias("first_day"), F.max("admit_date").alias("last_day"))


def calendar(span: DataFrame, name: str = "date") -> DataFrame:
    """Every day of the span."""
    days = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    return span.where("first_day IS NOT NULL").select(F.explode(days).alias(name))


def daily_changes(feat: DataFrame) -> DataFrame:
    """Admissions and, shifted to the following day, discharges per calendar day."""
    admits = feat.groupBy(F.col("admit_date").alias("date")).agg(F.count("*").alias("admits"))
    leaves = (
        feat.where("discharge_date IS NOT NULL")
        .groupBy(F.date_add("discharge_date", 1).alias("date"))
        .agg(F.count("*").alias("leaves"))
    )
    return (
        calendar(day_span(feat))
        .join(admits, "date", "left")
        .join(leaves, "date", "left")
        .select("date", (F.coalesce("admits", F.lit(0)) - F.coalesce("leaves", F.lit(0))).alias("change"))
    )


def historical_occupancy(feat: DataFrame, capacity: int = CONFIG.bed_capacity) -> DataFrame:
    """Census on every calendar day; the running sum sees one row per day."""
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    beds = F.greatest(F.sum("change").over(so_far), F.lit(0))
    return daily_changes(feat).select("date", beds.alias("occupied_beds")).withColumn(
        "occupancy_pct", clip(F.col("occupied_beds") * 100 / F.lit(float(capacity)), 0, 100)
    )


def latest_snapshot(feat: DataFrame, capacity: int = CONFIG.bed_capacity) -> DataFrame:
    """One row describing the last admission day."""
    complexity_p75 = exact_quantiles(feat, {"patient_complexity_index": [0.75]})["patient_complexity_index"][0]
    # One row per doctor and day: the 90th percentile of the load needs only how often each load occurs.
    loads = feat.groupBy("admit_date", "doctor_id").agg(F.count("*").alias("load"))
    load_counts = loads.groupBy("load").agg(F.count("*").alias("days"))
    reference = load_counts.agg(F.percentile("load", F.lit(0.9), F.col("days")).alias("p90"))
    last_day = feat.agg(F.max("admit_date")).scalar()
    recent = feat.where(F.col("admit_date") >= F.date_sub(last_day, 29)).withColumn("as_of_date", last_day)
    is_today = F.col("admit_date") == F.col("as_of_date")
    urgent = F.col("admit_type") == "Emergency"
    critical = (F.col("ward_type") == "ICU") | (F.col("patient_complexity_index") >= F.lit(complexity_p75))
    today = recent.groupBy("as_of_date").agg(
        F.countDistinct(F.when(is_today, F.col("patient_id"))).alias("patients_today"),
        F.countDistinct(F.when(is_today & critical, F.col("patient_id"))).alias("critical_patients"),
        mean(F.when(is_today & urgent, F.col("waiting_time_minutes"))).alias("urgent_today"),
        mean(F.when(urgent, F.col("waiting_time_minutes"))).alias("urgent_recent"),
        ratio(F.count_if(is_today), F.countDistinct(F.when(is_today, F.col("doctor_id")))).alias("mean_load"),
    )
    census = historical_occupancy(feat, capacity).groupBy().agg(
        F.max_by("occupied_beds", "date").alias("occupied_beds"), F.max_by("occupancy_pct", "date").alias("occupancy_pct")
    )
    return (
        beside(today, census, reference)
        .select(
            "as_of_date",
            "patients_today",
            "occupancy_pct",
            "occupied_beds",
            F.coalesce("urgent_today", "urgent_recent").alias("emergency_wait_minutes"),
            "critical_patients",
            (F.least(F.col("mean_load") / F.greatest("p90", F.lit(1.0)), F.lit(1.0)) * 100).alias("doctor_utilization_pct"),
        )
    )


def department_summary(feat: DataFrame) -> DataFrame:
    return feat.groupBy("department").agg(
        F.countDistinct("patient_id").alias("patients"),
        F.count("admission_id").alias("admissions"),
        mean("waiting_time_minutes").alias("average_wait"),
        mean("readmitted_30d").alias("readmission_rate"),
        mean("bed_utilization_score").alias("bed_utilization"),
    )


def _flow_score(wait: str, config: OpsConfig) -> Column:
    return clip(F.lit(100) - F.col(wait) / config.wait_ceiling_minutes * 100, 0, 100)


def hospital_rates(feat: DataFrame, bill: DataFrame) -> DataFrame:
    """Readmission, wait and collection rate of the whole hospital, one row."""
    care = feat.agg(mean("readmitted_30d").alias("readmission"), mean("waiting_time_minutes").alias("average_wait"))
    cash = bill.agg(
        ratio(
            F.coalesce(F.sum("paid_amount"), F.lit(0)),
            F.greatest(F.coalesce(F.sum("billed_amount"), F.lit(0)).cast("decimal(28,2)"), F.lit(1).cast("decimal(28,2)")),
        ).alias("collection")
    )
    return beside(care, cash)


def efficiency_scores(
    feat: DataFrame, bill: DataFrame, snapshot: DataFrame, config: OpsConfig = CONFIG
) -> DataFrame:
    """Weighted score of the hospital and of every department."""
    span = config.readmission_ceiling - config.readmission_target
    hospital = (
        beside(hospital_rates(feat, bill), snapshot.select("occupancy_pct"))
        .select(
            F.lit("hospital").alias("scope_type"),
            F.lit("Hospital portfolio").alias("scope_name"),
            clip((F.lit(config.readmission_ceiling) - F.col("readmission")) / F.lit(span) * 100, 0, 100).alias("patient_outcome_score"),
            clip(F.col("collection") / config.collection_target * 100, 0, 100).alias("collection_score"),
            clip(F.lit(100) - F.abs(F.col("occupancy_pct") - config.occupancy_target_pct) * 2, 0, 100).alias("capacity_balance_score"),
            _flow_score("average_wait", config).alias("patient_flow_score"),
            F.lit("mixed_observed_derived_simulated_assumed").alias("provenance"),
        )
        .withColumn(
            "efficiency_score",
            F.col("patient_outcome_score") * 0.40
            + F.col("collection_score") * 0.30
            + F.col("capacity_balance_score") * 0.20
            + F.col("patient_flow_score") * 0.10,
        )
    )
    pressure = F.greatest(F.max("bed_utilization").over(Window.partitionBy()), F.lit(0.01))
    departments = (
        department_summary(feat)
        .select(
            F.lit("department").alias("scope_type"),
            F.col("department").alias("scope_name"),
            ((1 - F.col("readmission_rate")) * 100).alias("patient_outcome_score"),
            F.lit(None).cast("double").alias("collection_score"),
            clip(F.col("bed_utilization") / pressure * 100, 0, 100).alias("capacity_balance_score"),
            _flow_score("average_wait", config).alias("patient_flow_score"),
            F.lit("derived_portfolio_dimension").alias("provenance"),
        )
        .withColumn(
            "efficiency_score",
            F.col("patient_outcome_score") * 0.50
            + F.col("patient_flow_score") * 0.25
            + F.col("capacity_balance_score") * 0.25,
        )
    )
    return hospital.unionByName(departments).select(
        "scope_type", "scope_name", "efficiency_score", "patient_outcome_score", "collection_score",
        "capacity_balance_score", "patient_flow_score", "provenance",
    )


def next_days(span: DataFrame, days: int, name: str = "forecast_date") -> DataFrame:
    """The days following the span."""
    ahead = F.sequence(F.date_add("last_day", 1), F.date_add("last_day", days), F.expr("interval 1 day"))
    return span.where("last_day IS NOT NULL").select(F.explode(ahead).alias(name))


def emergency_forecast(feat: DataFrame) -> DataFrame:
    """Next seven days from the weekday means of the last 56 calendar days; days without arrivals count as zero."""
    span = day_span(feat)
    urgent = feat.where(F.col("admit_type") == "Emergency").groupBy(F.col("admit_date").alias("date")).agg(
        F.count("*").alias("patients")
    )
    recent_span = span.select(
        F.greatest("first_day", F.date_sub("last_day", BASELINE_DAYS - 1)).alias("first_day"), "last_day"
    )
    recent = calendar(recent_span).join(urgent, "date", "left").select(
        F.weekday("date").alias("weekday"), F.coalesce("patients", F.lit(0)).alias("patients")
    )
    by_weekday = recent.groupBy("weekday").agg(mean("patients").alias("weekday_mean"))
    overall = recent.agg(mean("patients")).scalar()
    return (
        next_days(span, FORECAST_DAYS)
        .withColumn("weekday", F.weekday("forecast_date"))
        .join(by_weekday, "weekday", "left")
        .select(
            "forecast_date",
            F.coalesce("weekday_mean", overall).alias("forecast_emergency_patients"),
            F.lit("eight_week_weekday_seasonal_baseline").alias("method"),
            F.lit("forecast_from_observed_daily_emergency_admissions").alias("provenance"),
        )
    )


def forecast_summary(
    feat: DataFrame, occupancy_forecast: DataFrame | None, emergency: DataFrame, capacity: int = CONFIG.bed_capacity
) -> DataFrame:
    """Next-week outlook. Without a bed forecast no additional beds are planned."""
    last_week = (
        feat.where(F.col("admit_type") == "Emergency")
        .groupBy("admit_date")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("admit_date"))
        .limit(7)
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("prior_week"))
    )
    outlook = emergency.agg(
        F.min("forecast_date").alias("forecast_start_date"),
        F.max("forecast_date").alias("forecast_end_date"),
        F.sum("forecast_emergency_patients").alias("next_week"),
        F.min(F.struct((-F.col("forecast_emergency_patients")).alias("v"), F.col("forecast_date").alias("d"))).alias("peak"),
    )
    beds_now = historical_occupancy(feat, capacity).agg(F.max_by("occupied_beds", "date").alias("beds_now"))
    combined = beside(outlook, last_week, beds_now)
    if occupancy_forecast is None:
        combined = combined.withColumn("bed_peak", F.lit(None).cast("bigint"))
    else:
        opening = occupancy_forecast.agg(F.min("forecast_date")).scalar()
        first_week = occupancy_forecast.where(F.col("forecast_date") < F.date_add(opening, 7))
        combined = beside(combined, first_week.agg(F.ceil(F.max("forecast_occupied_beds")).alias("bed_peak")))
    return combined.select(
        "forecast_start_date",
        "forecast_end_date",
        half_even(F.col("next_week")).cast("bigint").alias("emergency_patients"),
        F.when(F.col("prior_week") > 0, (F.col("next_week") / F.col("prior_week") - 1) * 100)
        .otherwise(0.0)
        .alias("emergency_growth_pct"),
        F.greatest(F.coalesce("bed_peak", "beds_now") - F.col("beds_now"), F.lit(0)).alias("additional_beds"),
        F.date_format("peak.d", "EEEE").alias("peak_day"),
        half_even(-F.col("peak.v")).cast("bigint").alias("peak_day_volume"),
        F.lit("weekday_seasonal_emergency_baseline_plus_registered_occupied_bed_forecast").alias("method"),
        F.lit("unavailable_no_arrival_timestamps").alias("peak_hour_status"),
    )


# Wording of the three rules (priority, title, action, owner, timeframe, success measure, reliability).
READMISSION_RULE = (
    "P1", "Readmission control",
    "Prioritize ICU discharge review and post-discharge follow-up.",
    "Clinical Quality Lead", "30 days",
    "Root-cause review completed and approved ward target set",
    "observed",
)
COLLECTION_RULE = (
    "P1", "Collection recovery",
    "Review payer-specific billed-to-paid gaps and aged claims.",
    "Revenue Cycle Manager", "30 days",
    "Collection rate monitored against illustrative 70% threshold",
    "observed",
)
QUEUE_RULE = (
    "P2", "Queue-data readiness",
    "Capture arrival, triage, and service-start timestamps before staffing optimization.",
    "Operations Data Owner", "60 days",
    "Observed queue timestamps pass completeness checks",
    "simulated_workflow_measure",
)


def recommendations(feat: DataFrame, bill: DataFrame, snapshot: DataFrame, config: OpsConfig = CONFIG) -> DataFrame:
    """Threshold rules over one row of rates; a rule that does not apply yields no row."""
    rates = beside(hospital_rates(feat, bill), snapshot.select("emergency_wait_minutes"))
    rules = (
        (
            READMISSION_RULE,
            F.coalesce(F.col("readmission") > config.readmission_target, F.lit(False)),
            F.concat(percent_text(F.col("readmission")), F.lit(" hospital-wide readmission")),
        ),
        (
            COLLECTION_RULE,
            F.coalesce(F.col("collection") < config.collection_target, F.lit(False)),
            F.concat(percent_text(F.col("collection")), F.lit(" of billed value collected")),
        ),
        (
            QUEUE_RULE,
            F.lit(True),
            F.concat(
                half_even(F.col("emergency_wait_minutes")).cast("bigint").cast("string"),
                F.lit(" minute simulated emergency wait"),
            ),
        ),
    )
    fields = []
    for (priority, title, action, owner, timeframe, success, reliability), applies, signal in rules:
        fields.append(
            F.struct(
                applies.alias("applies"),
                F.lit(priority).alias("priority"),
                F.lit(title).alias("title"),
                signal.alias("signal"),
                F.lit(action).alias("action"),
                F.lit(owner).alias("owner"),
                F.lit(timeframe).alias("timeframe"),
                F.lit(success).alias("success_measure"),
                F.lit(reliability).alias("reliability"),
            )
        )
    return rates.select(F.inline(F.array(*fields))).where("applies").drop("applies")


def build_marts(
    feat: DataFrame,
    bill: DataFrame,
    occupancy_forecast: DataFrame | None = None,
    config: OpsConfig = CONFIG,
    store: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> dict[str, DataFrame]:
    """The five marts. ``store`` may write each mart, so those built on another one read it back."""
    snapshot = store(latest_snapshot(feat, config.bed_capacity), "snapshot")
    scores = store(efficiency_scores(feat, bill, snapshot, config), "hospital_efficiency_scores")
    overall = scores.where(F.col("scope_type") == "hospital").select(
        F.col("efficiency_score").alias("hospital_efficiency_score")
    )
    center = (
        beside(snapshot, overall)
        .withColumn("capacity_assumption", F.lit(config.bed_capacity))
        .withColumn("snapshot_provenance", F.lit("observed_latest_date_with_derived_and_simulated_metrics"))
    )
    emergency = store(emergency_forecast(feat), "emergency_forecast")
    outlook = forecast_summary(feat, occupancy_forecast, emergency, config.bed_capacity)
    return {
        "command_center_kpis": center,
        "hospital_efficiency_scores": scores,
        "emergency_forecast": emergency,
        "operational_forecast_summary": store(outlook, "operational_forecast_summary"),
        "operational_recommendations": store(recommendations(feat, bill, snapshot, config), "operational_recommendations"),
    }


def metric_rows(one_row: DataFrame, names: dict[str, str]) -> DataFrame:
    """Turn the columns of a one-row frame into (metric, value) rows."""
    renamed = one_row.select(*[F.col(c).cast("double").alias(label) for c, label in names.items()])
    return renamed.unpivot([], list(names.values()), "metric", "value")


def executive_kpi_rows(wh: dict[str, DataFrame]) -> DataFrame:
    care = wh["admissions"].agg(
        F.count("*").alias("a"),
        mean("readmitted_30d").alias("r"),
        mean("los_days").alias("l"),
        mean("waiting_time_minutes").alias("w"),
    )
    people = wh["patients"].agg(F.countDistinct("patient_id").alias("p"))
    cash = wh["billing"].agg(F.sum("paid_amount").alias("m"))
    approval = wh["claims"].agg(mean("claim_approved").alias("c"))
    return metric_rows(
        beside(care, people, cash, approval),
        {
            "a": "Admissions",
            "p": "Patients",
            "r": "Readmission Rate",
            "l": "Average LOS",
            "w": "Average Waiting Time",
            "m": "Paid Revenue",
            "c": "Claim Approval Ratio",
        },
    )


def _leader(df: DataFrame, label: str, value: str) -> DataFrame:
    """Label with the largest value; the first label in name order wins a tie."""
    best = F.min(F.struct((-F.col(value)).alias("v"), F.col(label).alias("label"))).alias("best")
    return df.where(F.col(value).isNotNull()).agg(best).select(
        F.col("best.label").alias("label"), (-F.col("best.v")).alias("value")
    )


def _insight(leader: DataFrame, area: str, reliability: str, use: str, text: Column) -> DataFrame:
    return leader.select(
        F.lit(area).alias("area"), F.lit(reliability).alias("reliability"), F.lit(use).alias("decision_use"),
        text.alias("insight"),
    )


def business_insights(feat: DataFrame, bill: DataFrame) -> DataFrame:
    """Five headline findings, each from its own small aggregate."""
    ward = feat.groupBy("ward_type").agg(mean("readmitted_30d").alias("v"))
    hospital = feat.groupBy("hospital_id").agg(F.count("*").alias("v"))
    payer = bill.groupBy("insurance_provider").agg(F.sum("claim_gap").alias("v"))
    wait = feat.groupBy("ward_type").agg(mean("waiting_time_minutes").alias("v"))
    p75 = exact_quantiles(feat, {"patient_complexity_index": [0.75]})["patient_complexity_index"][0]
    top = feat.where(F.col("patient_complexity_index") >= F.lit(p75)).agg(mean("readmitted_30d").alias("value"))
    whole = lambda c: F.format_number(c.cast("double"), 0)
    value = F.col("value")
    rows = [
        _insight(
            _leader(ward, "ward_type", "v"), "Patient outcomes", "Observed", "Prioritize ward-level discharge review.",
            F.concat("label", F.lit(" has the highest observed ward readmission rate at "), percent_text(value), F.lit(".")),
        ),
        _insight(
            _leader(hospital, "hospital_id", "v"), "Hospital flow", "Observed",
            "Use for site-level capacity and staffing review.",
            F.concat("label", F.lit(" records the highest admission volume with "), whole(value), F.lit(" encounters.")),
        ),
        _insight(
            _leader(payer, "insurance_provider", "v"), "Claims", "Observed",
            "Focus denial management on payer-specific gaps.",
            F.concat("label", F.lit(" has the largest observed billed-to-paid gap at "), whole(value), F.lit(".")),
        ),
        _insight(
            _leader(wait, "ward_type", "v"), "Waiting scenario", "Simulated",
            "Demonstrates queue-model workflow only; replace with timestamp data.",
            F.concat("label", F.lit(" has the highest simulated average wait at "), F.format_string("%.1f", half_even(value, 1)), F.lit(" minutes.")),
        ),
        _insight(
            top, "Risk", "Derived from observed clinical fields",
            "Use as a screening segment, not a causal conclusion.",
            F.concat(F.lit("Patients in the top complexity quartile have a "), percent_text(value), F.lit(" readmission rate.")),
        ),
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


# The standing governance action where claims are linked by position.
GOVERNANCE_ACTION = Row(
    priority="P2",
    action="Replace surrogate claim links and derived master data",
    owner="Data Governance Lead",
    timeframe="90 days",
    success_measure="Governed encounter, provider, department, and patient keys",
    evidence="Source files have no shared encounter key",
)
# The same where they carry an encounter key.
MASTER_DATA_ACTION = Row(
    priority="P2",
    action="Replace derived master data",
    owner="Data Governance Lead",
    timeframe="90 days",
    success_measure="Governed provider, department, and patient keys",
    evidence="Claims are linked by a governed encounter key; departments, doctors and demographics are derived",
)


def executive_action_plan(recs: DataFrame, link: str = SURROGATE_LINK) -> DataFrame:
    """The recommendations and the standing governance action that fits how bills were linked."""
    action = GOVERNANCE_ACTION if link == SURROGATE_LINK else MASTER_DATA_ACTION
    columns = ["priority", "action", "owner", "timeframe", "success_measure", "evidence"]
    plan = recs.withColumnRenamed("signal", "evidence").select(*columns)
    return plan.unionByName(recs.sparkSession.createDataFrame([action]))
