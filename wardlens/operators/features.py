"""Feature engineering: one wide row per admission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.config import BILLING_LABELS, DEPARTMENTS, DOCTORS_PER_DEPARTMENT, GENDERS, GOVERNED_LINK, MEDICINES
from wardlens.functions.columns import age_band, flag, half_even, money, pick, ratio, season, stable_int
from wardlens.functions.scale import exact_quantiles, materialize_small, order_statistics, with_order_chunks
from wardlens.ml.models import READMISSION_FEATURES, REVENUE_FEATURES, WAITING_FEATURES

VISIT_ORDER = ("patient_id", "admit_date", "admission_id")

# Minutes added to the simulated wait per admission type, and for any other type.
WAIT_BY_TYPE = {"Emergency": 18.0, "OPD": 28.0, "Elective": 8.0}
WAIT_OTHER = 12.0

FEATURE_COLUMNS = (
    "admission_id", "patient_id", "hospital_id", "admit_date", "discharge_date", "los_days", "admit_type",
    "ward_type", "discharge_type", "num_procedures", "charlson_index", "hba1c", "creatinine", "haemoglobin",
    "systolic_bp", "readmitted_30d", "readmitted_7d", "department", "doctor_id", "age", "gender",
    "medicine_code", "medicine_count", "admit_month", "admit_dayofweek", "is_weekend_admission", "age_group",
    "season", "previous_admissions", "readmission_history", "department_daily_admissions", "department_load",
    "disease_severity_score", "lab_abnormality_score", "doctor_experience", "bed_utilization_score",
    "patient_complexity_index", "risk_score", "waiting_time_minutes", "waiting_time_origin",
    "average_waiting_time", "total_procedures", "billed_amount", "paid_amount", "claim_approval_ratio",
    "claim_count", "revenue_per_patient", "revenue_origin", "billing_category", "insurance_category",
    "average_medicine_cost", "department_origin", "doctor_origin", "demographics_origin", "medicine_origin",
)


def with_derived_dimensions(adm: DataFrame) -> DataFrame:
    """Department, doctor, demographics, medicine and calendar parts: expressions over one row."""
    n = len(DEPARTMENTS)
    dept_no = (stable_int("hospital_id", n) + stable_int("ward_type", 3)) % n
    return (
        adm.withColumn("dept_no", dept_no)
        .withColumns(
            {
                "department": pick(DEPARTMENTS, F.col("dept_no")),
                "doctor_id": F.concat(
                    F.lit("DOC"),
                    F.lpad(
                        (
                            F.col("dept_no") * DOCTORS_PER_DEPARTMENT
                            + stable_int("admission_id", DOCTORS_PER_DEPARTMENT)
                            + 1
                        ).cast("string"),
                        3,
                        "0",
                    ),
                ),
                "age": stable_int("patient_id", 72) + 18,
                "gender": pick(GENDERS, stable_int("patient_id", len(GENDERS))),
                "medicine_code": pick(MEDICINES, stable_int("admission_id", len(MEDICINES))),
                "medicine_count": F.col("num_procedures") + 1 + flag(F.col("charlson_index") > 2),
                "admit_month": F.month("admit_date"),
                "admit_dayofweek": F.weekday("admit_date"),
            }
        )
        .withColumns(
            {
                "is_weekend_admission": flag(F.col("admit_dayofweek") >= 5),
                "age_group": age_band(F.col("age")),
                "season": season(F.col("admit_month")),
                "doctor_experience": stable_int("doctor_id", 28) + 2,
                "total_procedures": F.col("num_procedures"),
            }
        )
        .drop("dept_no")
    )


def visit_history(adm: DataFrame) -> DataFrame:
    """Visit number and earlier readmissions per admission.

    Only the four columns this needs are range-partitioned in visit order and frozen with their chunk. A
    patient whose visits fill several chunks is counted chunk by chunk; only the carried totals of such
    patients (at most one patient per chunk boundary) are broadcast.
    """
    chunked = with_order_chunks(adm.select(*VISIT_ORDER, "readmitted_30d"), VISIT_ORDER, "visits")
    per_chunk = chunked.groupBy("patient_id", "chunk").agg(
        F.count("*").alias("visits"), F.sum("readmitted_30d").alias("readmits")
    )
    earlier = Window.partitionBy("patient_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        per_chunk.withColumn("visits_before", F.sum("visits").over(earlier))
        .withColumn("readmits_before", F.sum("readmits").over(earlier))
        .where("visits_before IS NOT NULL")
        .select("patient_id", "chunk", "visits_before", "readmits_before")
    )
    visits = Window.partitionBy("patient_id", "chunk").orderBy("admit_date", "admission_id")
    before = F.sum("readmitted_30d").over(visits.rowsBetween(Window.unboundedPreceding, -1))
    return (
        chunked.withColumn("visit", F.row_number().over(visits).cast("bigint") - 1)
        .withColumn("readmits", F.coalesce(before, F.lit(0.0)))
        .join(F.broadcast(carried), ["patient_id", "chunk"], "left")
        .select(
            "admission_id",
            (F.col("visit") + F.coalesce("visits_before", F.lit(0))).alias("previous_admissions"),
            (F.col("readmits") + F.coalesce("readmits_before", F.lit(0.0))).alias("readmission_history"),
        )
    )


def department_daily(adm: DataFrame) -> DataFrame:
    """Admissions per department and day with the overall peak: one row per department and calendar day."""
    daily = adm.groupBy("department", "admit_date").agg(F.count("*").alias("department_daily_admissions"))
    return materialize_small(daily, "department_daily")


def with_load(adm: DataFrame, daily: DataFrame) -> DataFrame:
    peak = daily.agg(F.max("department_daily_admissions")).scalar()
    sized = daily.withColumn("department_load", ratio(F.col("department_daily_admissions"), peak))
    return adm.join(sized, ["department", "admit_date"], "left")


def with_waiting_time(adm: DataFrame) -> DataFrame:
    """Simulated wait, rounded half to even."""
    extra = F.lit(WAIT_OTHER)
    for kind, minutes in WAIT_BY_TYPE.items():
        extra = F.when(F.col("admit_type") == kind, F.lit(minutes)).otherwise(extra)
    minutes = (
        F.lit(18)
        + F.col("department_daily_admissions") * F.lit(1.7)
        + extra
        + F.col("is_weekend_admission") * 9
        + F.col("charlson_index") * 2
    )
    return adm.withColumn("waiting_time_minutes", half_even(minutes))


def with_clinical_scores(adm: DataFrame) -> DataFrame:
    abnormal = (
        flag(F.col("hba1c") > 7)
        + flag(F.col("creatinine") > 1.3)
        + flag(F.col("haemoglobin") < 11)
        + flag(F.col("systolic_bp") > 140)
    )
    return (
        adm.withColumn("lab_abnormality_score", abnormal)
        .withColumn("disease_severity_score", F.col("charlson_index") * 2 + F.col("lab_abnormality_score"))
        .withColumn(
            "patient_complexity_index",
            F.col("disease_severity_score") + F.col("previous_admissions") + F.col("num_procedures"),
        )
        .withColumn(
            "bed_utilization_score", F.least(F.lit(1.0), F.col("los_days") * F.col("department_load") / 8)
        )
        .withColumn(
            "risk_score",
            F.col("patient_complexity_index") * 0.30
            + F.col("los_days") * 0.25
            + F.col("readmission_history") * 0.20
            + F.col("lab_abnormality_score") * 0.15
            + F.col("department_load") * 0.10,
        )
    )


def average_wait_by_department(adm: DataFrame) -> DataFrame:
    return adm.groupBy("department").agg(
        ratio(F.sum("waiting_time_minutes"), F.count("waiting_time_minutes")).alias("average_waiting_time")
    )


def billing_summary(bill: DataFrame) -> DataFrame:
    """Per admission: amounts, approval share and number of bills (``billing_id`` is unique)."""
    return bill.groupBy("admission_id").agg(
        F.sum("billed_amount").alias("billed_sum"),
        F.sum("paid_amount").alias("paid_sum"),
        ratio(F.sum("claim_approved"), F.count("claim_approved")).alias("approval_mean"),
        F.count("billing_id").alias("bills"),
        governed_link().alias("link"),
    )


def governed_link() -> Column:
    """The governed method if it is the largest of a group's methods, else null: as flags, so that no strings are sorted."""
    method = F.col("linkage_method")
    return F.when(F.max(method == GOVERNED_LINK) & ~F.max(method > GOVERNED_LINK), GOVERNED_LINK)


def summary_of_sums(sums: DataFrame) -> DataFrame:
    """``billing_summary`` read from the stored totals per admission."""
    return sums.select(
        "admission_id", F.col("billed").alias("billed_sum"), F.col("paid").alias("paid_sum"),
        ratio(F.col("approved"), F.col("rated")).alias("approval_mean"), "bills", "link",
    )


def with_amounts(adm: DataFrame) -> DataFrame:
    """Billed and paid per admission; an admission without bills gets the cost formula."""
    estimate = F.col("los_days") * 650 + 900 + F.col("num_procedures") * 1200 + F.col("charlson_index") * 300
    billed = F.coalesce(F.col("billed_sum").cast("decimal(24,2)"), estimate.cast("decimal(24,2)"))
    share = F.lit("0.72").cast("decimal(2,2)")
    return adm.withColumn("billed_amount", money(billed)).withColumn(
        "paid_amount", money(F.coalesce(F.col("paid_sum"), F.col("billed_amount") * share))
    )


def with_finance(adm: DataFrame) -> DataFrame:
    """Financial features of admissions that already carry their bill summary."""
    return (
        with_amounts(adm)
        .withColumn("claim_approval_ratio", F.coalesce("approval_mean", F.lit(0.72)))
        .withColumn("claim_count", F.coalesce("bills", F.lit(0)))
        .withColumn("revenue_per_patient", F.col("paid_amount"))
        .withColumn(
            "revenue_origin",
            F.when(F.col("link") == GOVERNED_LINK, "governed_linked_claim")
            .when(F.col("claim_count") > 0, "surrogate_linked_claim")
            .otherwise("simulated_cost_formula"),
        )
        .withColumn("insurance_category", F.when(F.col("claim_count") > 0, "Insurance").otherwise("Self Pay"))
        .withColumn(
            "average_medicine_cost",
            half_even(F.col("billed_amount").cast("double") * 0.12 / F.col("medicine_count"), 2).cast("decimal(14,2)"),
        )
        .drop("billed_sum", "paid_sum", "approval_mean", "bills", "link")
    )


BILLING_ORDER = ("billed_amount", *VISIT_ORDER)


def billing_cut_rows(priced: DataFrame, rows: int) -> list[tuple]:
    """The last row of each of the first three billed-amount quartiles; none if there are no rows.

    With ranks 1..n the quartile edges are 1 + (n-1)·k/4 and bins are closed on the right, so bin k ends
    at the 1-based rank floor(edge). Ties keep the visit order, as a first-come rank does.
    """
    if not rows:
        return []
    ranks = {k: (rows - 1) * k // 4 for k in (1, 2, 3)}
    found = order_statistics(priced, BILLING_ORDER, sorted(set(ranks.values())), "billing_ranks")
    return [tuple(found[ranks[k]][c] for c in BILLING_ORDER) for k in (1, 2, 3)]


def with_billing_category(df: DataFrame, cuts: list[tuple]) -> DataFrame:
    """Quartile label by comparing each row with the three cut rows."""
    types = dict(df.dtypes)
    position = F.struct(*BILLING_ORDER)
    label = F.lit(BILLING_LABELS[3])
    for name, cut in reversed(list(zip(BILLING_LABELS, cuts))):
        edge = F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(BILLING_ORDER, cut)])
        label = F.when(position <= edge, F.lit(name)).otherwise(label)
    return df.withColumn("billing_category", label)


def with_origins(df: DataFrame) -> DataFrame:
    derived = F.lit("deterministic_derived_dimension")
    return df.withColumns(
        {
            "waiting_time_origin": F.lit("simulated_formula"),
            "department_origin": derived,
            "doctor_origin": derived,
            "demographics_origin": derived,
            "medicine_origin": derived,
        }
    )


def engineer_features(
    adm: DataFrame, bill: DataFrame, partitions: int | None = None, sums: DataFrame | None = None
) -> DataFrame:
    """All features, one row per admission.

    The wide rows are moved once, by admission id: visit history and bill summary are narrow tables joined
    on that key, department figures are small. With ``partitions`` all sides of those joins share one
    partitioning, which a table bucketed into that many buckets can be written from directly. ``sums`` may supply the
    written totals of the same bills, bucketed alike.
    """

    def spread(df: DataFrame) -> DataFrame:
        return df if partitions is None else df.repartition(partitions, "admission_id")

    daily = department_daily(with_derived_dimensions(adm))

    def timed(df: DataFrame) -> DataFrame:
        return with_waiting_time(with_load(with_derived_dimensions(df), daily))

    waits = average_wait_by_department(timed(adm))
    summary = spread(billing_summary(bill)) if sums is None else summary_of_sums(sums)
    cuts = billing_cut_rows(with_amounts(spread(adm).join(summary, "admission_id", "left")), adm.count())
    joined = (
        timed(spread(adm))  # moved before its derived columns widen it
        .join(F.broadcast(waits), "department", "left")
        .join(spread(visit_history(adm)), "admission_id")
        .join(summary, "admission_id", "left")
    )
    priced = with_finance(with_clinical_scores(joined))
    return with_origins(with_billing_category(priced, cuts)).select(*FEATURE_COLUMNS)


# Features a model row may not miss.
REQUIRED_FEATURES = tuple(sorted({*READMISSION_FEATURES, *WAITING_FEATURES, *REVENUE_FEATURES}))


def feature_checks(feat: DataFrame) -> DataFrame:
    """Failure counts of six engineering rules."""
    repeated = feat.groupBy("admission_id").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n"))
    missing = sum((F.col(c).isNull().cast("int") for c in REQUIRED_FEATURES), F.lit(0))
    leak = flag((F.col("previous_admissions") == 0) & (F.col("readmission_history") != 0))
    not_binary = F.lit(1) - flag(F.col("readmitted_30d").isin(0, 1))
    rules = {
        "No missing model features": missing,
        "No first-visit history leakage": leak,
        "Readmission target is binary": not_binary,
        "Waiting time is non-negative": flag(F.col("waiting_time_minutes") < 0),
        "Revenue is non-negative": flag(F.col("revenue_per_patient") < 0),
    }
    totals = feat.agg(*[F.sum(e).alias(name) for name, e in rules.items()])
    failures = totals.unpivot([], list(rules), "check", "failures")
    return repeated.select(F.lit("One row per admission").alias("check"), F.col("n").alias("failures")).unionByName(failures)


# Origin of each feature family.
PROVENANCE = (
    ("readmitted_30d", "Observed", "Admissions source"),
    ("los_days", "Observed", "Admissions source"),
    ("clinical_labs", "Observed", "Admissions source"),
    ("hospital_id", "Observed", "Admissions source"),
    ("ward_type", "Observed", "Admissions source"),
    ("claim_financials", "Observed", "Claims source only"),
    ("department", "Derived", "Deterministic portfolio dimension"),
    ("doctor_id", "Derived", "Deterministic portfolio dimension"),
    ("age_gender", "Derived", "Deterministic portfolio dimension"),
    ("medicine", "Derived", "Deterministic portfolio dimension"),
    ("waiting_time_minutes", "Simulated", "Formula-generated target"),
    ("revenue_per_patient", "Mixed", "Surrogate-linked or formula-generated"),
    ("admission_claim_link", "Derived", "No shared source identifier"),
    ("bed_capacity", "Assumption", "Configured portfolio capacity"),
)


def feature_provenance(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PROVENANCE), "feature string, provenance string, method string")


NUMERIC_DEFAULTS = (
    "los_days", "num_procedures", "charlson_index", "hba1c", "creatinine", "haemoglobin", "systolic_bp",
    "readmitted_30d", "readmitted_7d", "age", "medicine_count", "admit_month", "admit_dayofweek",
    "is_weekend_admission", "previous_admissions", "readmission_history", "department_daily_admissions",
    "department_load", "disease_severity_score", "lab_abnormality_score", "doctor_experience",
    "bed_utilization_score", "patient_complexity_index", "risk_score", "waiting_time_minutes",
    "average_waiting_time", "total_procedures", "billed_amount", "paid_amount", "claim_approval_ratio",
    "claim_count", "revenue_per_patient", "average_medicine_cost",
)
LABEL_DEFAULTS = (
    "hospital_id", "admit_type", "ward_type", "discharge_type", "department", "doctor_id", "gender",
    "medicine_code", "age_group", "season", "waiting_time_origin", "revenue_origin", "billing_category",
    "insurance_category", "department_origin", "doctor_origin", "demographics_origin", "medicine_origin",
)


def feature_defaults(feat: DataFrame) -> DataFrame:
    """Median of each numeric feature and most frequent value (smallest on ties) of each label."""
    medians = exact_quantiles(feat, {c: [0.5] for c in NUMERIC_DEFAULTS})
    numbers = feat.sparkSession.createDataFrame(
        [(c, medians[c][0], None) for c in NUMERIC_DEFAULTS],
        "feature string, numeric_default double, label_default string",
    )
    counts = (
        feat.select(*LABEL_DEFAULTS)
        .unpivot([], list(LABEL_DEFAULTS), "feature", "label_default")
        .where("label_default IS NOT NULL")
        .groupBy("feature", "label_default")
        .count()
    )
    modes = counts.groupBy("feature").agg(
        F.min(F.struct(-F.col("count"), F.col("label_default"))).alias("best")
    )
    labels = modes.select(
        "feature", F.lit(None).cast("double").alias("numeric_default"), F.col("best.label_default").alias("label_default")
    )
    return numbers.unionByName(labels)
