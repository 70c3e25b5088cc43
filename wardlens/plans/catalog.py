"""Registered queries: one entry per operator, run on a fixture folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.config import GOVERNED_LINK
from wardlens.functions.columns import stable_int
from wardlens.functions.scale import materialize, materialize_small, new_path
from wardlens.ml import explain, forecasting, metrics, models, splits, store
from wardlens.operators import cleaning, contracts, features, marts, measures, reports, validation, views
from wardlens.operators.analyses import ANALYSES
from wardlens.plans.dataset import HospitalData, open_fixture
from wardlens.sources import fixtures, loads, readers, sinks
from wardlens.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Plain result types for comparison across engines: bigint, double at six decimals, text."""

    def plain(field: T.StructField):
        c, t = F.col(f"`{field.name}`"), field.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double") if t.scale else c.cast("bigint")
        elif isinstance(t, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str) -> Callable[[Callable[[HospitalData], DataFrame]], Callable[[HospitalData], DataFrame]]:
    def register(fn: Callable[[HospitalData], DataFrame]) -> Callable[[HospitalData], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: comparable(fn(open_fixture(spark, sf_dir)))
        return fn

    return register


def raw_query(name: str) -> Callable[[Query], Query]:
    """A query on the raw extracts, before any stage is written."""

    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: comparable(fn(spark, sf_dir))
        return fn

    return register


# --- sources -----------------------------------------------------------------------------------------

raw_query("raw_admissions")(fixtures.raw_admissions)
raw_query("raw_billing")(fixtures.raw_billing)
raw_query("dirty_admissions")(fixtures.dirty_admissions)
raw_query("dirty_billing")(fixtures.dirty_billing)
query("table_counts")(lambda d: sinks.table_counts(d.warehouse))
query("query_evidence")(lambda d: sinks.query_evidence(d.warehouse_with_marts))


@query("load_in_fk_order")
def _load(d: HospitalData) -> DataFrame:
    """All tables, features and marts, in their order."""
    return sinks.load_in_fk_order(
        {n: d.warehouse_with_marts[n] for n in (*sinks.LOAD_ORDER, "model_features", *contracts.MART_CONTRACTS)},
        sinks.folder_sink(new_path(d.spark, "loaded")),
    )


@query("load_appended")
def _append(d: HospitalData) -> DataFrame:
    """A second load of all tables onto the first: as many rows added as the source has."""
    tables, sink = {n: d.warehouse[n] for n in sinks.LOAD_ORDER}, sinks.folder_sink(new_path(d.spark, "appended"))
    sinks.load_in_fk_order(tables, sink)
    return sinks.load_in_fk_order(tables, sink, truncate=False)


def _without_icu(d: HospitalData) -> dict[str, DataFrame]:
    """The warehouse's tables less the ICU admissions and what belongs to them."""
    wh = d.warehouse
    gone = wh["admissions"].where("ward_type = 'ICU'").select("admission_id")
    lost = materialize_small(wh["billing"].join(gone, "admission_id", "left_semi").select("billing_id"), "lost_bills")
    out = {n: wh[n] for n in sinks.LOAD_ORDER}
    for name in ("admissions", "diagnoses", "procedures", "medicines", "labs", "appointments"):
        out[name] = wh[name].join(gone, "admission_id", "left_anti")
    return {**out, **{n: wh[n].join(lost, "billing_id", "left_anti") for n in ("billing", "claims")}}


@query("load_repeated")
def _repeated(d: HospitalData) -> DataFrame:
    """All tables loaded after a load without the ICU, then the same load again: only the ICU is added, once."""
    target = loads.LoadedWarehouse(d.spark, new_path(d.spark, "loaded"))
    target.load(_without_icu(d), "without-icu")
    tables = {n: d.warehouse[n] for n in sinks.LOAD_ORDER}
    target.load(tables, "all")
    return target.load(tables, "all")


@query("load_interrupted")
def _interrupted(d: HospitalData) -> DataFrame:
    """A load that dies before its billing table, then rows read by then and after its repetition."""
    target = loads.LoadedWarehouse(d.spark, new_path(d.spark, "loaded"))
    tables = {n: d.warehouse[n] for n in sinks.LOAD_ORDER}

    def dying(df: DataFrame, path: str) -> None:
        if "/billing/" in path:
            raise InterruptedError
        loads.write_parquet(df, path)

    try:
        target.load(tables, "first", dying)
    except InterruptedError:
        visible = len(target.committed())
    report = target.load(tables, "first")
    stored = sinks.table_counts({n: target.read(n) for n in sinks.LOAD_ORDER}).withColumnRenamed("rows", "rows_read")
    return report.join(stored, "table_name").withColumn("loads_seen_after_crash", F.lit(visible))


@query("ingest_keyed_bills")
def _ingested(d: HospitalData) -> DataFrame:
    """Bills that land in three deliveries, one per batch; the third repeats bills of either earlier one. Stored once, with derived fields."""
    landing, target, checkpoint = (new_path(d.spark, n) for n in ("bills-landing", "bills-stored", "bills-checkpoint"))
    bills = d.billing_clean.drop("claim_gap", "claim_approved")
    part = stable_int("billing_id", 10)
    for chosen in (part < 6, part >= 6, (part == 1) | (part == 7)):
        bills.where(chosen).write.mode("append").parquet(landing)
        # One batch for all files that have landed; the next start goes on after it.
        arriving = ingest.arriving_bills(d.spark, landing, bills.schema, files_per_batch=1_000_000)
        ingest.ingest_keyed_bills(arriving, target, checkpoint).awaitTermination()
    return ingest.stored_bills(d.spark, target).drop(ingest.ARRIVED)


@query("stored_admissions_by_year")
def _stored(d: HospitalData) -> DataFrame:
    """Admissions written by year and read back."""
    folder = new_path(d.spark, "stored")
    sinks.write_warehouse({"admissions": d.warehouse["admissions"]}, folder)
    stored = sinks.read_warehouse(d.spark, folder, ["admissions"])["admissions"]
    return stored.groupBy("admit_year").agg(F.count("*").alias("admissions"), F.sum("los_days").alias("days"))


@query("read_table")
def _read_table(d: HospitalData) -> DataFrame:
    """Patients written as compressed CSV and found again by table name."""
    folder = new_path(d.spark, "csv")
    d.warehouse["patients"].write.option("header", True).option("compression", "gzip").csv(f"{folder}/patients.csv.gz")
    return readers.read_table(d.spark, folder, "patients", d.warehouse["patients"].schema)


@raw_query("read_raw_billing")
def _read_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Both extracts written as CSV with their columns in reverse order, ids with leading zeros, and read back."""
    folder = new_path(spark, "landing")
    padded = F.concat(F.lit("00"), F.regexp_replace("billing_id", "^BIL", "")).alias("billing_id")
    bill = fixtures.dirty_billing(spark, sf)
    for name, df in (("admissions", fixtures.dirty_admissions(spark, sf)), ("billing", bill.withColumn("billing_id", padded))):
        df.select(*reversed(df.columns)).write.option("header", True).csv(f"{folder}/{readers.RAW_FILES[name]}")
    return readers.read_raw(spark, folder)[1]


# --- validation and cleaning, on the dirty extracts -----------------------------------------------------

@raw_query("profile_raw")
def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return validation.validate_raw(fixtures.dirty_admissions(spark, sf), fixtures.dirty_billing(spark, sf))


@raw_query("rule_failures")
def _rules(spark: SparkSession, sf: str) -> DataFrame:
    return validation.rule_failures(fixtures.dirty_admissions(spark, sf), fixtures.dirty_billing(spark, sf))


@raw_query("missing_by_column")
def _missing(spark: SparkSession, sf: str) -> DataFrame:
    return validation.missing_by_column(fixtures.dirty_admissions(spark, sf)).unionByName(
        validation.missing_by_column(fixtures.dirty_billing(spark, sf).withColumnRenamed("patient_id", "billing_patient_id"))
    )


@raw_query("quality_comparison")
def _comparison(spark: SparkSession, sf: str) -> DataFrame:
    adm, bill = fixtures.dirty_admissions(spark, sf), fixtures.dirty_billing(spark, sf)
    return validation.quality_comparison(
        {
            "admissions": (adm, cleaning.clean_admissions(adm), "admission_id"),
            "claims": (bill, cleaning.clean_billing(bill), "billing_id"),
        }
    )


query("table_quality")(lambda d: validation.table_quality(d.warehouse))


@raw_query("join_cardinality")
def _cardinality(spark: SparkSession, sf: str) -> DataFrame:
    dirty = fixtures.dirty_admissions(spark, sf)
    return validation.cardinality_violations(dirty, dirty, ["admission_id"], "many_to_one")


query("describe_table")(lambda d: validation.describe_table(d.admissions_clean))


@raw_query("drop_duplicate_keys")
def _dedup(spark: SparkSession, sf: str) -> DataFrame:
    adm = fixtures.dirty_admissions(spark, sf)
    # Content order among the wards' patients: the first row per patient by visit.
    return cleaning.drop_duplicate_keys(
        adm.select("patient_id", "admit_date", "admission_id", "ward_type"), "patient_id", ["admit_date", "admission_id"]
    )


@raw_query("coerce_dates")
def _dates(spark: SparkSession, sf: str) -> DataFrame:
    bill = fixtures.dirty_billing(spark, sf).select("billing_id", "claim_billing_date")
    return cleaning.coerce_dates(bill, ["claim_billing_date"], dayfirst=True)


def _numbers(spark: SparkSession, sf: str) -> DataFrame:
    adm = cleaning.drop_duplicate_keys(
        fixtures.dirty_admissions(spark, sf).select("admission_id", *cleaning.ADMISSION_NUMERICS),
        "admission_id", cleaning.ADMISSION_NUMERICS,
    )
    # Written once: learning medians and fences reads the narrow table, not the extract.
    return materialize(cleaning.to_numbers(adm, cleaning.ADMISSION_NUMERICS), "numbers")


raw_query("impute_median")(lambda s, sf: cleaning.impute_median(_numbers(s, sf), cleaning.ADMISSION_NUMERICS))
raw_query("winsorize_iqr")(
    lambda s, sf: cleaning.winsorize_iqr(
        cleaning.impute_median(_numbers(s, sf), cleaning.ADMISSION_NUMERICS), cleaning.ADMISSION_NUMERICS
    )
)


@raw_query("impute_median_amounts")
def _amounts(spark: SparkSession, sf: str) -> DataFrame:
    bill = fixtures.raw_billing(spark, sf).select("billing_id", "claim_status", "billed_amount")
    open_amount = F.when(F.col("claim_status") != "Pending", F.col("billed_amount"))
    return cleaning.impute_median(bill.withColumn("billed_amount", open_amount), ["billed_amount"])


@raw_query("fill_unknown_trim")
def _unknown(spark: SparkSession, sf: str) -> DataFrame:
    bill = fixtures.dirty_billing(spark, sf).select("billing_id", "insurance_provider", "payment_method")
    return cleaning.fill_unknown_trim(
        bill.withColumn("payment_method", F.concat(F.lit("  "), "payment_method", F.lit(" "))),
        ["insurance_provider", "payment_method"],
    )


@raw_query("clip_lower")
def _floor(spark: SparkSession, sf: str) -> DataFrame:
    adm = fixtures.raw_admissions(spark, sf).select("admission_id", (F.col("los_days") - 4).alias("los_days"))
    return cleaning.clip_lower(adm, ["los_days"])


raw_query("clean_admissions")(lambda s, sf: cleaning.clean_admissions(fixtures.dirty_admissions(s, sf)))
raw_query("clean_billing")(lambda s, sf: cleaning.clean_billing(fixtures.dirty_billing(s, sf)))


@raw_query("derive_claim_fields")
def _derive(spark: SparkSession, sf: str) -> DataFrame:
    # Cash lines are treated as overpaid by a tenth, so the floor of the gap is exercised.
    bill = fixtures.raw_billing(spark, sf)
    paid = F.when(
        F.col("payment_method") == "Cash", (F.col("billed_amount") * F.lit("1.1").cast("decimal(3,2)")).cast("decimal(14,2)")
    ).otherwise(F.col("paid_amount"))
    return cleaning.derive_claim_fields(bill.withColumn("paid_amount", paid)).select(
        "billing_id", "paid_amount", "claim_gap", "claim_approved"
    )


@raw_query("link_billing_to_admissions")
def _link(spark: SparkSession, sf: str) -> DataFrame:
    # The dirty bills have missing dates, so the fallback to the discharge date is exercised.
    bill = cleaning.clean_billing(fixtures.dirty_billing(spark, sf))
    adm = cleaning.clean_admissions(fixtures.dirty_admissions(spark, sf))
    return cleaning.link_billing_to_admissions(bill, adm).select(
        "billing_id", "admission_id", "patient_id", "source_patient_id", "source_encounter_id", "claim_billing_date",
        "linkage_method",
    )


query("link_billing_by_encounter")(lambda d: d.billing_linked.drop("insurance_id"))

# --- features ------------------------------------------------------------------------------------------

# Operator -> feature columns it produces; each is checked per admission.
FEATURE_FAMILIES = {
    "feature_department": ("department",),
    "feature_doctor": ("doctor_id",),
    "feature_demographics": ("age", "gender"),
    "feature_medicine": ("medicine_code", "medicine_count", "total_procedures"),
    "feature_calendar": ("admit_month", "admit_dayofweek", "is_weekend_admission"),
    "feature_age_group": ("age", "age_group"),
    "feature_season": ("admit_month", "season"),
    "feature_previous_admissions": ("patient_id", "previous_admissions"),
    "feature_readmission_history": ("patient_id", "readmission_history"),
    "feature_department_load": ("department_daily_admissions", "department_load"),
    "feature_clinical_scores": ("disease_severity_score", "lab_abnormality_score"),
    "feature_doctor_experience": ("doctor_id", "doctor_experience"),
    "feature_bed_utilization": ("bed_utilization_score",),
    "feature_risk_score": ("patient_complexity_index", "risk_score"),
    "feature_waiting_time": ("waiting_time_minutes", "waiting_time_origin"),
    "feature_average_wait": ("department", "average_waiting_time"),
    "feature_billing_summary": ("claim_count", "claim_approval_ratio"),
    "feature_finance": ("billed_amount", "paid_amount", "revenue_per_patient", "revenue_origin"),
    "feature_billing_category": ("billed_amount", "billing_category"),
    "feature_insurance": ("insurance_category", "average_medicine_cost"),
    "feature_origins": ("department_origin", "doctor_origin", "demographics_origin", "medicine_origin"),
}
for _name, _columns in FEATURE_FAMILIES.items():
    query(_name)(lambda d, c=_columns: d.features.select("admission_id", *c))

query("engineer_features")(lambda d: d.features)


@raw_query("stable_int")
def _stable(spark: SparkSession, sf: str) -> DataFrame:
    ids = fixtures.raw_admissions(spark, sf).select("admission_id")
    return ids.withColumn("bucket", stable_int("admission_id", 1000))


query("feature_checks")(lambda d: features.feature_checks(d.features))
query("feature_defaults")(lambda d: features.feature_defaults(d.features))

# --- warehouse, views, reports ---------------------------------------------------------------------------

for _name in (
    "patients", "departments", "doctors", "admissions", "diagnoses", "procedures", "medicines", "labs", "insurance",
    "billing", "claims", "appointments",
):
    if _name != "departments":  # eight literal rows, covered by the joins below
        query(f"table_{_name}")(lambda d, n=_name: d.warehouse[n])

VIEWS = {
    "vw_executive_kpis": views.executive_kpis,
    "vw_command_center": views.command_center,
    "vw_efficiency_ranking": views.efficiency_ranking,
    "vw_operational_action_queue": views.operational_action_queue,
    "vw_department_kpis": views.department_kpis,
    "vw_doctor_utilization": views.doctor_utilization,
    "vw_monthly_revenue": views.monthly_revenue,
    "vw_bed_occupancy": views.bed_occupancy,
    "vw_daily_occupancy": views.daily_occupancy,
    "vw_patient_360": views.patient_360,
    "billing_claims": views.billing_claims,
}
for _name, _view in VIEWS.items():
    query(_name)(lambda d, v=_view: v(d.warehouse_with_marts))

query("monthly_operations_report")(lambda d: views.monthly_operations_report(d.warehouse, 1998, 3))
query("patient_360_report")(lambda d: views.patient_360(d.warehouse, "PAT7"))
query("command_center_scores")(lambda d: views.command_center_report(d.warehouse_with_marts)[1])

for _name, _analysis in ANALYSES.items():
    query(_name)(lambda d, a=_analysis: a(d.warehouse_with_marts))

query("doctors_with_readmissions")(
    lambda d: ANALYSES["q08_high_readmission_doctors"](d.warehouse, min_admissions=10)
)
query("weekday_census_alert")(lambda d: ANALYSES["q51_high_occupancy_days"](d.warehouse, alert_pct=5))

# --- marts ------------------------------------------------------------------------------------------------

query("historical_occupancy")(lambda d: marts.historical_occupancy(d.features))
query("latest_snapshot")(lambda d: marts.latest_snapshot(d.features))
query("department_summary")(lambda d: marts.department_summary(d.features))
query("efficiency_scores")(lambda d: d.marts["hospital_efficiency_scores"])
query("emergency_forecast")(lambda d: marts.emergency_forecast(d.features))
query("recommendations")(lambda d: d.marts["operational_recommendations"])
query("command_center_kpis")(lambda d: d.marts["command_center_kpis"])
query("operational_forecast_summary")(lambda d: d.marts["operational_forecast_summary"])
query("executive_kpi_rows")(lambda d: marts.executive_kpi_rows(d.warehouse))
query("business_insights")(lambda d: marts.business_insights(d.features, d.billing_linked))
query("executive_action_plan")(
    lambda d: marts.executive_action_plan(d.marts["operational_recommendations"], GOVERNED_LINK)
)

# --- reporting aggregates ------------------------------------------------------------------------------------

query("monthly_activity")(lambda d: reports.monthly_activity(d.features))
query("admission_growth")(lambda d: reports.admission_growth(reports.monthly_activity(d.features)))
query("monthly_finance")(lambda d: reports.monthly_finance(d.warehouse["billing"]))
query("yearly_trend")(lambda d: reports.yearly_trend(d.features))
query("ward_summary")(lambda d: reports.ward_summary(d.features))
query("admit_type_summary")(lambda d: reports.admit_type_summary(d.features))
query("payer_summary")(lambda d: reports.payer_summary(d.warehouse["billing"], d.warehouse["insurance"], d.warehouse["claims"]))
query("claim_status_counts")(lambda d: reports.claim_status_counts(d.warehouse["claims"]))
query("finance_totals")(lambda d: reports.finance_totals(d.warehouse["billing"], d.warehouse["claims"]))
query("rolling_admissions")(lambda d: reports.rolling_admissions(reports.monthly_activity(d.features)))
query("high_complexity_cohort")(lambda d: reports.high_complexity_cohort(d.features))
query("department_performance")(lambda d: reports.department_performance(d.features))
query("department_heatmap")(lambda d: reports.department_heatmap(reports.department_performance(d.features)))
query("doctor_performance")(lambda d: reports.doctor_performance(d.features))
query("doctor_leaderboard")(lambda d: reports.doctor_leaderboard(reports.doctor_performance(d.features), 12))
query("doctor_leaders_by_revenue")(
    lambda d: reports.doctor_leaderboard(
        reports.doctor_performance(d.features), 3, "revenue", ["Cardiology", "Surgery", "Oncology"]
    )
)
query("patient_search")(lambda d: reports.patient_search(d.features, " pat12 "))
query("patient_timeline")(lambda d: reports.patient_timeline(d.features, "PAT7"))
query("latest_encounter")(lambda d: reports.latest_encounter(d.features))
query("risk_class")(lambda d: reports.risk_class(d.features))
query("risk_segmentation")(lambda d: reports.risk_segmentation(d.features))
query("patient_flow_funnel")(lambda d: reports.patient_flow_funnel(d.features))
query("age_histogram")(lambda d: reports.age_histogram(d.features))
query("weekday_volume")(lambda d: reports.weekday_volume(d.features))
query("risk_comparison")(lambda d: reports.risk_comparison(d.features))
query("correlation_matrix")(lambda d: reports.correlation_matrix(d.features))
query("bed_status")(lambda d: reports.current_census(d.features))
query("trailing_occupancy")(lambda d: reports.trailing_occupancy(marts.historical_occupancy(d.features)))
query("department_bed_pressure")(lambda d: reports.department_bed_pressure(d.features))
query("revenue_long")(lambda d: reports.revenue_long(reports.monthly_finance(d.warehouse["billing"])))
query("icu_weekend_share")(lambda d: reports.icu_weekend_share(d.features))
query("top_department_contribution")(
    lambda d: reports.top_department_contribution(reports.department_performance(d.features))
)

# --- measures -------------------------------------------------------------------------------------------------

query("measures_total")(lambda d: measures.measures(d.warehouse))
query("measures_by_department")(lambda d: measures.measures(d.warehouse, ["department"]))
query("measures_by_ward_and_gender")(lambda d: measures.measures(d.warehouse, ["ward_type", "gender"]))
query("revenue_growth")(lambda d: measures.revenue_growth(d.warehouse))
query("trailing_admissions")(lambda d: measures.trailing_admissions(d.warehouse))
query("command_center_measures")(lambda d: measures.command_center_measures(d.marts))
query("department_efficiency_score")(lambda d: measures.department_efficiency_score(d.marts))

# --- contracts --------------------------------------------------------------------------------------------------

query("check_primary_keys")(lambda d: contracts.check_primary_keys(d.warehouse))
query("check_foreign_keys")(lambda d: contracts.check_foreign_keys(d.warehouse))
query("check_admission_dates")(lambda d: contracts.check_admission_dates(d.warehouse))
query("check_domain_rules")(lambda d: contracts.check_domain_rules(d.warehouse))
@query("partial_linkage")
def _partial_linkage(d: HospitalData) -> DataFrame:
    """Bills and amounts by linkage method when the ICU's admissions are absent."""
    present = d.admissions_clean.where("ward_type <> 'ICU'")
    return cleaning.linkage_summary(cleaning.link_billing_by_encounter(d.billing_clean, present))


query("check_provenance")(
    lambda d: contracts.check_provenance(
        features.feature_provenance(d.spark),
        marts.business_insights(d.features, d.billing_linked),
        marts.executive_action_plan(d.marts["operational_recommendations"], GOVERNED_LINK),
    )
)
query("check_mart_shape")(lambda d: contracts.check_mart_shape(d.marts))
query("check_mart_consistency")(lambda d: contracts.check_mart_consistency(d.warehouse, d.marts))


@query("damaged_provenance")
def _damaged_provenance(d: HospitalData) -> DataFrame:
    """Reports with one kind of provenance missing, an unlabelled insight and an action without owner."""
    plan = marts.executive_action_plan(d.marts["operational_recommendations"], GOVERNED_LINK)
    return contracts.check_provenance(
        features.feature_provenance(d.spark).where("provenance <> 'Simulated'"),
        marts.business_insights(d.features, d.billing_linked).drop("reliability"),
        plan.withColumn("owner", F.when(F.col("priority") != "P2", F.col("owner"))),
    )


@query("damaged_marts")
def _damaged_marts(d: HospitalData) -> DataFrame:
    """Marts with an unknown day, no forecast summary and a score out of range."""
    center, scores = d.marts["command_center_kpis"], d.marts["hospital_efficiency_scores"]
    return contracts.check_mart_consistency(
        d.warehouse,
        {
            **d.marts,
            "command_center_kpis": center.withColumn("as_of_date", F.lit(None).cast("date")),
            "operational_forecast_summary": d.marts["operational_forecast_summary"].where("false"),
            "hospital_efficiency_scores": scores.withColumn("efficiency_score", F.when(
                F.col("scope_type") == "hospital", F.col("efficiency_score")
            ).otherwise(F.lit(101.0))),
        },
    )


@query("validate")
def _validate(d: HospitalData) -> DataFrame:
    return contracts.validate(
        d.warehouse, d.marts, features.feature_provenance(d.spark), marts.business_insights(d.features, d.billing_linked),
        marts.executive_action_plan(d.marts["operational_recommendations"], GOVERNED_LINK), _registry(d), _explained(d),
    )


query("dataset_fingerprint")(lambda d: contracts.dataset_fingerprint(d.features))


@query("fingerprint_after_append")
def _appended_fingerprint(d: HospitalData) -> DataFrame:
    """Fingerprint per ward, of all wards but the ICU from their states, and of the whole with the ICU appended."""
    states = contracts.fingerprint_state(d.features, "ward_type")
    icu = states.where("ward_type = 'ICU'").drop("ward_type")
    whole = contracts.merged_state(states.drop("ward_type"))
    rest = contracts.merged_state(whole, removed=icu)
    again = contracts.merged_state(rest.unionByName(icu))
    parts = [states, *(s.withColumn("ward_type", F.lit(n)) for n, s in (("without ICU", rest), ("with ICU again", again)))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(
        F.col("ward_type").alias("part"), "rows", contracts.content_hash()
    )


@query("changed_wards")
def _changed_wards(d: HospitalData) -> DataFrame:
    """Where a copy of the features was changed: one value in the HDU, all rows of the NICU lost."""
    first = d.features.where("ward_type = 'HDU'").agg(F.min("admission_id")).scalar()
    copy = d.features.where("ward_type <> 'NICU'").withColumn(
        "creatinine", F.when(F.col("admission_id") == first, F.col("creatinine") + 1).otherwise(F.col("creatinine"))
    )
    return contracts.changed_parts(
        contracts.fingerprint_state(d.features, "ward_type"), contracts.fingerprint_state(copy, "ward_type"), "ward_type"
    )


@raw_query("orphaned_bills")
def _orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Foreign keys of a warehouse whose ICU admissions were lost."""
    wh = open_fixture(spark, sf).warehouse
    damaged = wh.with_tables({"admissions": wh["admissions"].where("ward_type <> 'ICU'")})
    return contracts.orphan_counts(damaged)


# --- splits, metrics and forecasting -----------------------------------------------------------------------------

query("group_split")(lambda d: splits.split_audit(splits.with_group_side(d.features, "patient_id"), "patient_id"))
query("chronological_split")(lambda d: splits.chronological_split(d.census, ["date", "series"])[0])
query("sample_rows")(lambda d: splits.sample_rows(d.features.select("admission_id", "patient_id"), "admission_id", 500))


@query("classification_metrics")
def _classified(d: HospitalData) -> DataFrame:
    # The risk score as a simple classifier of readmission.
    scored = d.features.select(
        F.col("readmitted_30d").alias("label"),
        F.col("risk_score").alias("probability"),
        (F.col("risk_score") >= 7).cast("double").alias("prediction"),
    )
    return metrics.classification_metrics(scored)


query("occupancy_features")(lambda d: forecasting.occupancy_features(forecasting.census_by(d.features, "ward_type")))


def _baseline(d: HospitalData) -> DataFrame:
    return forecasting.moving_average_baseline(forecasting.occupancy_features(d.census))


query("moving_average_baseline")(_baseline)
query("regression_metrics")(lambda d: metrics.regression_metrics(_baseline(d)))


def _baseline_forecast(d: HospitalData) -> DataFrame:
    """The baseline read as a forecast of the test period."""
    beds = F.col("prediction")
    return _baseline(d).select(
        "series", F.col("date").alias("forecast_date"), beds.alias("forecast_occupied_beds"),
        F.least(beds / d.config.bed_capacity * 100, F.lit(100.0)).alias("forecast_occupancy_pct"),
    )


query("horizon_summary")(lambda d: forecasting.horizon_summary(_baseline_forecast(d)))
query("forecast_horizon")(lambda d: reports.forecast_horizon(_baseline_forecast(d), 30))


@query("forecast_horizon_by_ward")
def _ward_horizon(d: HospitalData) -> DataFrame:
    """Every ward's census read as its forecast, from its own first day on."""
    census = forecasting.census_by(d.features, "ward_type").select(
        "series", F.col("date").alias("forecast_date"), F.col("occupied_beds").alias("forecast_occupied_beds")
    )
    return reports.forecast_horizon(census, 30)


@query("forecast_summary_with_beds")
def _with_beds(d: HospitalData) -> DataFrame:
    # The bed baseline of the test period stands in for a trained forecast.
    return marts.forecast_summary(d.features, _baseline_forecast(d), marts.emergency_forecast(d.features))


query("occupancy_models")(lambda d: d.trained("occupancy").metrics)
query("occupancy_forecast")(lambda d: d.occupancy_forecast)
query("command_center_with_forecast")(lambda d: views.command_center(d.marts_with_forecast))


@query("occupancy_forecast_by_department")
def _department_beds(d: HospitalData) -> DataFrame:
    daily = materialize_small(forecasting.census_by(d.features, "department"), "department_census")
    model = forecasting.fit_occupancy(forecasting.occupancy_features(daily), forecasting.BOOSTED, d.model_sizes)
    return forecasting.forecast_recursive(daily, model, horizon=30)


# --- models -------------------------------------------------------------------------------------------------------

query("train_readmission")(lambda d: d.trained("readmission").metrics)
query("train_waiting")(lambda d: d.trained("waiting_simulation").metrics)
query("train_revenue")(lambda d: d.trained("revenue_scenario").metrics)
query("standardized_features")(lambda d: models.standardized(d.features, models.READMISSION_FEATURES))
query("grid_search")(lambda d: models.grid_search(d.features))
query("ward_predictions")(lambda d: models.ward_predictions(d.trained("revenue_scenario").holdout))
query("residuals")(lambda d: models.residuals(d.trained("waiting_simulation").holdout))
query("readmission_scores")(lambda d: explain.score_readmission(d.trained("readmission").model, d.features))
query("waiting_scenario")(
    lambda d: explain.scenario_scores(d.trained("waiting_simulation").model, d.features, "waiting_time_minutes")
)
query("revenue_scenario")(
    lambda d: explain.scenario_scores(d.trained("revenue_scenario").model, d.features, "revenue_per_patient", 250)
)
query("readmission_drivers")(
    lambda d: explain.linear_contributions(d.trained("readmission").model, d.features, models.READMISSION_FEATURES)
)
query("readmission_importance")(lambda d: d.explanation("readmission"))
query("revenue_importance")(lambda d: d.explanation("revenue_scenario"))
query("top_positive_driver")(
    lambda d: explain.top_positive_driver(d.trained("readmission").model, d.features, models.READMISSION_FEATURES)
)
query("readmission_permutation_importance")(
    lambda d: explain.permutation_importance(
        d.trained("readmission").model, d.features, models.READMISSION_FEATURES, "readmitted_30d", classes=True
    )
)
query("revenue_permutation_importance")(
    lambda d: explain.permutation_importance(
        d.trained("revenue_scenario").model, d.features, models.REVENUE_FEATURES, "revenue_per_patient"
    )
)
query("department_forecast")(lambda d: reports.department_forecast(d.trained("revenue_scenario").holdout))


@query("planned_revenue_monthly")
def _planned(d: HospitalData) -> DataFrame:
    scored = d.trained("revenue_scenario").model.transform(d.features).select("admit_date", "prediction")
    return reports.planned_revenue_monthly(reports.planned_revenue_daily(scored))


TASKS = ("readmission", "waiting_simulation", "revenue_scenario", "occupancy")
EXPLAINED = ("readmission", "revenue_scenario")


def _registry(d: HospitalData) -> DataFrame:
    """The stored models, their files judged as they are now."""
    return models.registry(d.spark, [m.lineage() for m in d.stored_all(TASKS).values()])


query("model_registry")(lambda d: _registry(d).withColumn("features", F.concat_ws(",", "features")))


def _explained(d: HospitalData) -> DataFrame:
    """What the published explanations were made from."""
    rows = []
    for task in EXPLAINED:
        d.explanation(task)
        found = d.stored(task).explanation()
        rows.append((task, found["model_hash"], found["report_intact"]))
    return d.spark.createDataFrame(rows, "task string, model_hash string, report_intact boolean")


query("check_model_lineage")(lambda d: contracts.check_model_lineage(_registry(d), _explained(d)))


@query("damaged_lineage")
def _damaged_lineage(d: HospitalData) -> DataFrame:
    """A registry with shared patients in one task, and an explanation of another model."""
    shared = F.when(F.col("task") == "waiting_simulation", F.lit(3)).otherwise(F.col("patient_overlap"))
    other = F.when(F.col("task") == "readmission", F.lit("other")).otherwise(F.col("model_hash"))
    return contracts.check_model_lineage(
        _registry(d).withColumn("patient_overlap", shared), _explained(d).withColumn("model_hash", other)
    )


@query("damaged_artifact")
def _damaged_artifact(d: HospitalData) -> DataFrame:
    """A registry with one model's files changed after they were published."""
    stored = d.stored_all(TASKS)
    copies = store.ModelStore(d.spark, new_path(d.spark, "models"))
    copy = copies.publish("copy", d.trained("waiting_simulation"))
    d.trained("waiting_simulation").metrics.write.mode("append").parquet(f"{copy.artifact}/metrics")
    return contracts.check_model_lineage(
        models.registry(d.spark, [copy.lineage() if t == "waiting_simulation" else m.lineage() for t, m in stored.items()])
    )
