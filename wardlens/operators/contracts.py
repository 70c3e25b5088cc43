"""Data contracts over a built warehouse and its marts (K1-K9)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions.scale import beside
from wardlens.sources.schemas import CONTRACT_KEYS, FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS

Tables = Mapping[str, DataFrame]

# Columns and exact row counts (None: at least one row) of the marts.
MART_CONTRACTS = {
    "command_center_kpis": (
        {
            "as_of_date", "patients_today", "occupancy_pct", "occupied_beds", "emergency_wait_minutes",
            "critical_patients", "doctor_utilization_pct", "hospital_efficiency_score", "snapshot_provenance",
        },
        1,
    ),
    "hospital_efficiency_scores": (
        {
            "scope_type", "scope_name", "efficiency_score", "patient_outcome_score", "capacity_balance_score",
            "patient_flow_score", "provenance",
        },
        None,
    ),
    "emergency_forecast": ({"forecast_date", "forecast_emergency_patients", "method", "provenance"}, 7),
    "operational_forecast_summary": (
        {
            "forecast_start_date", "forecast_end_date", "emergency_patients", "additional_beds", "peak_day", "method",
            "peak_hour_status",
        },
        1,
    ),
    "operational_recommendations": (
        {"priority", "title", "signal", "action", "owner", "timeframe", "success_measure", "reliability"},
        None,
    ),
}
# Accepted lineage and provenance labels.
TARGET_ORIGINS = ("observed", "simulated_formula", "mixed_surrogate_and_simulated", "observed_active_census")
PORTFOLIO_TIERS = ("core_analytical", "sandbox")
PROVENANCE_KINDS = ("Observed", "Derived", "Simulated", "Mixed", "Assumption")


def _check(df: DataFrame, name: str, failed: Column, rows: Column) -> DataFrame:
    """One row per row of ``df``, an aggregate; what cannot be judged has failed."""
    status = F.when(F.coalesce(failed, F.lit(True)), "failed").otherwise("passed")
    return df.select(F.lit(name).alias("check"), status.alias("status"), rows.cast("bigint").alias("rows"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def check_primary_keys(wh: Tables) -> DataFrame:
    """Key unique and not null, per table; counted per key before anything is gathered."""
    checks = []
    for table in CONTRACT_KEYS:
        key = PRIMARY_KEYS[table]
        per_key = wh[table].groupBy(*key).agg(F.count("*").alias("n"))
        missing = reduce(Column.__or__, [F.col(c).isNull() for c in key])
        totals = per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count_if((F.col("n") > 1) | missing).alias("bad"),
        )
        checks.append(_check(totals, f"table:{table}", F.col("bad") > 0, F.col("rows")))
    return _union(checks)


def orphan_counts(wh: Tables) -> DataFrame:
    """Rows without a parent per foreign key. Child keys are counted first, so a hot key is one record."""
    counts = []
    for child, key, parent, parent_key in FOREIGN_KEYS:
        per_key = wh[child].groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
        parents = wh[parent].select(F.col(parent_key).alias("k"), F.lit(True).alias("known")).where("k IS NOT NULL")
        joined = per_key.join(parents.dropDuplicates(["k"]), "k", "left")
        counts.append(
            joined.agg(
                F.lit(f"{child}.{key}").alias("relation"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("orphans"),
            )
        )
    return _union(counts)


def check_foreign_keys(wh: Tables) -> DataFrame:
    return orphan_counts(wh).select(
        F.concat(F.lit("foreign_key:"), "relation").alias("check"),
        F.when(F.col("orphans") > 0, "failed").otherwise("passed").alias("status"),
        "rows",
    )


def check_admission_dates(wh: Tables) -> DataFrame:
    valid = F.coalesce(F.col("discharge_date") >= F.col("admit_date"), F.lit(False))
    totals = wh["admissions"].agg(F.count("*").alias("rows"), F.count_if(~valid).alias("bad"))
    return _check(totals, "business_rule:admission_date_order", F.col("bad") > 0, F.col("rows"))


def check_domain_rules(wh: Tables) -> DataFrame:
    """Value ranges, required columns and unique names of the relational schema."""
    rules: list[tuple[str, str, Column]] = [
        ("patients", "age_range", ~F.col("age").between(0, 120)),
        ("admissions", "discharge_after_admit", F.col("discharge_date") < F.col("admit_date")),
    ]
    for table, columns in NOT_NULL.items():
        rules.append((table, "required_columns", reduce(Column.__or__, [F.col(c).isNull() for c in columns])))
    checks = []
    for table, name, broken in rules:
        totals = wh[table].agg(F.count("*").alias("rows"), F.count_if(F.coalesce(broken, F.lit(False))).alias("bad"))
        checks.append(_check(totals, f"domain:{table}.{name}", F.col("bad") > 0, F.col("rows")))
    for table, column in (("departments", "department"), ("insurance", "insurance_provider")):
        totals = wh[table].groupBy(column).count().agg(F.sum("count").alias("rows"), F.count_if(F.col("count") > 1).alias("bad"))
        checks.append(_check(totals, f"domain:{table}.unique_{column}", F.col("bad") > 0, F.col("rows")))
    return _union(checks)


def check_provenance(provenance: DataFrame, insights: DataFrame, actions: DataFrame) -> DataFrame:
    kinds = provenance.agg(
        F.count("*").alias("rows"),
        F.countDistinct(F.when(F.col("provenance").isin(*PROVENANCE_KINDS), F.col("provenance"))).alias("kinds"),
    )
    labelled = {"reliability", "decision_use", "insight"} <= set(insights.columns)
    accountable = {"priority", "action", "owner", "timeframe", "success_measure", "evidence"} <= set(actions.columns)
    insight_rows = insights.agg(F.count("*").alias("rows"))
    action_rows = actions.agg(
        F.count("*").alias("rows"), F.count_if(F.col("owner").isNull() | F.col("timeframe").isNull()).alias("bad")
    )
    return _union(
        [
            _check(kinds, "report:feature_provenance", F.col("kinds") < len(PROVENANCE_KINDS), F.col("rows")),
            _check(insight_rows, "report:business_insights", F.lit(not labelled), F.col("rows")),
            _check(action_rows, "report:accountable_action_plan", F.lit(not accountable) | (F.col("bad") > 0), F.col("rows")),
        ]
    )


def check_mart_shape(marts: Tables) -> DataFrame:
    checks = []
    for name, (columns, rows) in MART_CONTRACTS.items():
        complete = columns <= set(marts[name].columns)
        size = marts[name].agg(F.count("*").alias("rows"))
        wrong = F.col("rows") < 1 if rows is None else F.col("rows") != rows
        checks.append(_check(size, f"operational_mart:{name}", F.lit(not complete) | wrong, F.col("rows")))
    return _union(checks)


def check_mart_consistency(wh: Tables, marts: Tables) -> DataFrame:
    """Dates, ranges and scores agree across the marts and with the admissions."""
    last = wh["admissions"].agg(F.max("admit_date").alias("last_day"))
    scores = marts["hospital_efficiency_scores"]
    hospital = scores.where(F.col("scope_type") == "hospital").agg(
        F.count("*").alias("hospitals"), F.max("efficiency_score").alias("score")
    )
    in_range = lambda c: F.coalesce(F.col(c).between(0, 100), F.lit(False))
    ranges = in_range("occupancy_pct") & in_range("doctor_utilization_pct") & in_range("hospital_efficiency_score")
    center = beside(
        marts["command_center_kpis"].agg(
            F.count("*").alias("rows"), F.count("as_of_date").alias("dated"), F.min("as_of_date").alias("from_day"),
            F.max("as_of_date").alias("to_day"), F.count_if(~ranges).alias("bad"),
            F.max("hospital_efficiency_score").alias("hospital_efficiency_score"),
        ),
        last,
    )
    dates = beside(
        marts["emergency_forecast"].agg(
            F.count("*").alias("rows"), F.countDistinct("forecast_date").alias("days"),
            F.min("forecast_date").alias("first"), F.max("forecast_date").alias("final"),
        ),
        last,
    )
    accountable = reduce(
        Column.__or__, [F.col(c).isNull() for c in ("owner", "timeframe", "success_measure", "reliability")]
    )
    recs = marts["operational_recommendations"].agg(F.count("*").alias("rows"), F.count_if(accountable).alias("bad"))
    spread = scores.agg(F.count("*").alias("rows"), F.count_if(~in_range("efficiency_score")).alias("bad"))
    same = (F.col("hospitals") == 1) & (F.abs(F.col("score") - F.col("hospital_efficiency_score")) < 1e-6)
    stated = F.coalesce(F.col("peak_hour_status") == "unavailable_no_arrival_timestamps", F.lit(False))
    outlook = marts["operational_forecast_summary"].agg(
        F.count("*").alias("rows"), F.count_if(~stated).alias("bad")
    )
    none = F.col("rows") == 0
    off_day = (F.col("from_day") != F.col("last_day")) | (F.col("to_day") != F.col("last_day"))
    return _union(
        [
            _check(center, "consistency:as_of_date", none | (F.col("dated") < F.col("rows")) | off_day, F.col("rows")),
            _check(center, "consistency:center_ranges", none | (F.col("bad") > 0), F.col("rows")),
            _check(spread, "consistency:efficiency_range", none | (F.col("bad") > 0), F.col("rows")),
            _check(beside(center, hospital), "consistency:hospital_score", ~same, F.col("rows")),
            _check(
                dates, "consistency:forecast_dates",
                (F.col("first") <= F.col("last_day")) | (F.col("days") != F.col("rows")), F.col("rows"),
            ),
            _check(outlook, "consistency:peak_hour_status", none | (F.col("bad") > 0), F.col("rows")),
            _check(recs, "consistency:accountable_recommendations", none | (F.col("bad") > 0), F.col("rows")),
        ]
    )


LANES = ((1, 15), (16, 15))  # hexadecimal digits of a row's MD5 that are added up: twice 60 bits
WHOLE = 9e12  # numbers below it are compared by millionths


def row_text(df: DataFrame) -> Column:
    """All values of a row as one text, columns by name, the same in every engine: numbers in millionths, dates as text."""
    parts = []
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.NumericType):
            number = value.cast("double")
            millionths = F.floor(number * 1e6 + 0.5).cast("bigint").cast("string")
            text = F.when(F.abs(number) < WHOLE, millionths).otherwise(number.cast("string"))
        else:
            text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.lit("v"), text), F.lit("n")))
    return F.concat_ws("|", *parts)


def fingerprint_state(df: DataFrame, *by: str) -> DataFrame:
    """Row count and two sums of row hashes, per value of ``by``: sums of parts are the sums of the whole."""
    keyed = df.select(*by, F.md5(row_text(df)).alias("_digest"))
    lanes = [
        F.coalesce(F.sum(F.conv(F.substring("_digest", at, size), 16, 10).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias(f"lane_{k}")
        for k, (at, size) in enumerate(LANES)
    ]
    return keyed.groupBy(*by).agg(F.count("*").alias("rows"), *lanes)


def merged_state(parts: DataFrame, *by: str, removed: DataFrame | None = None) -> DataFrame:
    """The state of all parts together, without the ``removed`` ones, from states alone: no row is read again."""
    names = ("rows", *(f"lane_{k}" for k in range(len(LANES))))
    if removed is not None:
        parts = parts.unionByName(removed.select(*by, *[(-F.col(c)).alias(c) for c in names]))
    kinds = dict(zip(names, ("bigint", "decimal(38,0)", "decimal(38,0)")))
    return parts.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(kinds[c]).alias(c) for c in names])


def changed_parts(before: DataFrame, after: DataFrame, by: str) -> DataFrame:
    """Values of ``by`` whose rows differ between two states, with both row counts: where a table was changed."""
    lanes = [f"lane_{k}" for k in range(len(LANES))]
    old, new = (s.select(by, F.col("rows").alias(n), F.struct(*lanes).alias(f"{n}_sums")) for s, n in ((before, "rows_before"), (after, "rows_after")))
    differs = ~F.col("rows_before_sums").eqNullSafe(F.col("rows_after_sums")) | ~F.col("rows_before").eqNullSafe(F.col("rows_after"))
    return old.join(new, by, "full").where(differs).select(
        by, F.coalesce("rows_before", F.lit(0)).alias("rows_before"), F.coalesce("rows_after", F.lit(0)).alias("rows_after")
    )


def content_hash() -> Column:
    return F.concat_ws("-", *[F.col(f"lane_{k}").cast("string") for k in range(len(LANES))]).alias("content_hash")


def dataset_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-independent content hash."""
    return fingerprint_state(df).select("rows", content_hash())


def check_model_lineage(registry: DataFrame, explanations: DataFrame | None = None) -> DataFrame:
    """Rules every registered model obeys: files as published, no shared patients, known origin and tier, a stated use.

    ``registry`` may say in ``artifact_intact`` whether the stored files are unchanged; ``explanations`` gives per task the hash of
    the model that its explanation was made from, and in ``report_intact`` whether the report is unchanged.
    """
    stored = F.col("artifact_intact") if "artifact_intact" in registry.columns else F.lit(True)
    rules = registry.select(
        F.concat(F.lit("model:"), "task").alias("check"),
        (
            F.coalesce(stored, F.lit(True))
            & (F.coalesce("patient_overlap", F.lit(0)) == 0)
            & F.col("target_origin").isin(*TARGET_ORIGINS)
            & F.col("portfolio_tier").isin(*PORTFOLIO_TIERS)
            & (F.coalesce(F.length("decision_use"), F.lit(0)) > 0)
        ).alias("ok"),
        F.col("rows"),
    )
    checks = rules.select(
        "check", F.when(F.coalesce("ok", F.lit(False)), "passed").otherwise("failed").alias("status"), "rows"
    )
    if explanations is None:
        return checks
    reported = F.col("report_intact") if "report_intact" in explanations.columns else F.lit(True)
    link = "artifact_hash" if "artifact_hash" in registry.columns else "model_hash"
    linked = explanations.join(registry.select("task", F.col(link).alias("expected")), "task", "left").select(
        F.concat(F.lit("explanation:"), "task").alias("check"),
        F.when(F.coalesce((F.col("model_hash") == F.col("expected")) & reported, F.lit(False)), "passed").otherwise("failed").alias("status"),
        F.lit(None).cast("bigint").alias("rows"),
    )
    return checks.unionByName(linked)


def validate(
    wh: Tables, marts: Tables, provenance: DataFrame, insights: DataFrame, actions: DataFrame, registry: DataFrame,
    explanations: DataFrame | None = None,
) -> DataFrame:
    """Every table, relation, rule, mart, report and model contract as (check, status, rows)."""
    return _union(
        [
            check_primary_keys(wh),
            check_foreign_keys(wh),
            check_admission_dates(wh),
            check_domain_rules(wh),
            check_mart_shape(marts),
            check_mart_consistency(wh, marts),
            check_provenance(provenance, insights, actions),
            check_model_lineage(registry, explanations),
        ]
    )
