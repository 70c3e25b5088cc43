"""Cleaning and linkage of the raw extracts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.config import GOVERNED_LINK, SURROGATE_LINK
from wardlens.functions.columns import flag
from wardlens.functions.scale import count_columns, exact_quantiles, materialize, materialize_small, with_row_index

ADMISSION_NUMERICS = (
    "los_days", "num_procedures", "charlson_index", "hba1c", "creatinine", "haemoglobin", "systolic_bp",
    "readmitted_30d", "readmitted_7d",
)
ADMISSION_LABELS = ("admit_type", "ward_type", "discharge_type", "hospital_id")
BILLING_LABELS = ("insurance_provider", "payment_method", "claim_status")
ISO_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")
DAY_FIRST_FORMATS = ("d/M/yyyy", "d-M-yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")


def drop_duplicate_keys(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Keep the first row per key in ``order``.

    The minimum struct is combined before the shuffle, so a key repeated millions of times sends one row
    per map task instead of gathering all its copies in one sort.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("first")
    return df.groupBy(key).agg(first).select(*[F.col(key) if c == key else F.col(f"first.{c}") for c in df.columns])


MOST_REPEATED = 100_000  # repeated keys that are sent to every task; beyond them all rows meet by key


def first_rows(raw: DataFrame, key: str, name: str) -> tuple[DataFrame, bool]:
    """The first row per key, in the order of the other columns, and whether it is a stored table as it is.

    The rows are written once. A pass over hashes of the keys finds those that repeat, and only their rows meet in a
    shuffle; equal hashes of different keys send a few rows more on that way and change nothing.
    """
    stored = materialize(raw, name)
    order = [c for c in raw.columns if c != key]
    hashed = stored.withColumn("_hash", F.xxhash64(F.col(key)))
    repeated = materialize_small(hashed.groupBy("_hash").count().where("count > 1").select("_hash"), f"{name}_repeated")
    several = repeated.count()
    if not several:
        return stored, True
    if several > MOST_REPEATED:
        return drop_duplicate_keys(stored, key, order), False
    once = hashed.join(F.broadcast(repeated), "_hash", "left_anti").drop("_hash")
    copies = hashed.join(F.broadcast(repeated), "_hash", "left_semi").drop("_hash")
    return once.unionByName(drop_duplicate_keys(copies, key, order)), False


def _typed_once(raw: DataFrame, key: str, name: str, to_types: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The first rows with their types, as a table that is not computed again: texts are parsed once, other casts are cheap."""
    first, stored = first_rows(raw, key, f"{name}_raw")
    typed = to_types(first)
    before = dict(raw.dtypes)
    parsed = any(before[c] == "string" and kind != "string" for c, kind in typed.dtypes)
    return typed if stored and not parsed else materialize(typed, f"{name}_typed")


def coerce_dates(df: DataFrame, columns: Sequence[str], dayfirst: bool = False) -> DataFrame:
    """Parse text dates; anything unreadable becomes null. Date and timestamp columns are only cast."""
    types = dict(df.dtypes)
    formats = DAY_FIRST_FORMATS if dayfirst else ISO_FORMATS

    def parsed(c: str) -> Column:
        if types[c] != "string":
            return F.col(c).cast("date")
        return F.coalesce(*[F.try_to_timestamp(F.trim(c), F.lit(f)) for f in formats]).cast("date")

    return df.withColumns({c: parsed(c) for c in columns})


def to_numbers(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """Unreadable numbers become null."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c in columns})


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of the columns that have something to fill."""
    counts = count_columns(df, columns)
    needed = {c: [0.5] for c in columns if counts[c].nulls}
    return {c: q[0] for c, q in exact_quantiles(df, needed, counts).items()}


def impute(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in values.items() if v is not None}
    )


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return impute(df, fit_medians(df, columns))


def fill_unknown_trim(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("Unknown"))) for c in columns})


def _fence(q1: float | None, q3: float | None, k: float) -> tuple[float, float] | None:
    """Lower and upper fence, none for a column without spread."""
    if q1 is None or q3 - q1 <= 0:
        return None
    return q1 - k * (q3 - q1), q3 + k * (q3 - q1)


def fit_fences(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> dict[str, tuple[float, float]]:
    quartiles = exact_quantiles(df, {c: [0.25, 0.75] for c in columns})
    return {c: fence for c, (q1, q3) in quartiles.items() if (fence := _fence(q1, q3, k))}


def apply_fences(df: DataFrame, fences: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Null stays null, as in ``clip``."""
    return df.withColumns(
        {
            c: F.when(F.col(c) < low, F.lit(low)).when(F.col(c) > high, F.lit(high)).otherwise(F.col(c))
            for c, (low, high) in fences.items()
        }
    )


def winsorize_iqr(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    return apply_fences(df, fit_fences(df, columns, k))


def clip_lower(df: DataFrame, columns: Sequence[str], floor: float = 0) -> DataFrame:
    types = dict(df.dtypes)
    bound = {c: F.lit(floor).cast(types[c]) for c in columns}
    return df.withColumns({c: F.when(F.col(c) < bound[c], bound[c]).otherwise(F.col(c)) for c in columns})


@dataclass(frozen=True)
class CleaningRules:
    """Scalars learned from one data set; applying them is a narrow transformation."""

    medians: Mapping[str, float | None] = field(default_factory=dict)
    fences: Mapping[str, tuple[float, float]] = field(default_factory=dict)


def typed_admissions(first: DataFrame) -> DataFrame:
    """Admissions with readable dates and numbers."""
    return to_numbers(coerce_dates(first, ["admit_date", "discharge_date"]), ADMISSION_NUMERICS)


def fit_admissions(typed: DataFrame) -> CleaningRules:
    """Medians, and fences of the imputed values.

    Columns without gaps get their quartiles in the same pass as the medians; only columns that had gaps
    are read again after filling.
    """
    counts = count_columns(typed, ADMISSION_NUMERICS)
    quartiles = exact_quantiles(typed, {c: [0.25, 0.5, 0.75] for c in ADMISSION_NUMERICS}, counts)
    medians = {c: quartiles[c][1] for c in ADMISSION_NUMERICS if counts[c].nulls}
    fences = {c: f for c in ADMISSION_NUMERICS if c not in medians and (f := _fence(quartiles[c][0], quartiles[c][2], 1.5))}
    if medians:
        fences.update(fit_fences(impute(typed.select(*medians), medians), list(medians)))
    return CleaningRules(medians, fences)


def apply_admission_rules(typed: DataFrame, rules: CleaningRules) -> DataFrame:
    filled = fill_unknown_trim(impute(typed, rules.medians), ADMISSION_LABELS)
    return clip_lower(apply_fences(filled, rules.fences), ["los_days", "num_procedures", "charlson_index"])


def clean_admissions(raw: DataFrame) -> DataFrame:
    """Store, deduplicate and type the extract once; learn the rules from its narrow columns.

    The result is a row-wise transformation of that table.
    """
    typed = _typed_once(raw, "admission_id", "admissions", typed_admissions)
    return apply_admission_rules(typed, fit_admissions(typed))


def typed_billing(first: DataFrame) -> DataFrame:
    """Bills with readable dates and amounts; billing dates are day-first."""
    dated = coerce_dates(first, ["claim_billing_date"], dayfirst=True)
    return to_numbers(dated, ["billed_amount", "paid_amount"], "decimal(14,2)")


def fit_billing(typed: DataFrame) -> CleaningRules:
    return CleaningRules(fit_medians(typed, ["billed_amount", "paid_amount"]))


def apply_billing_rules(typed: DataFrame, rules: CleaningRules) -> DataFrame:
    floored = clip_lower(impute(typed, rules.medians), ["billed_amount", "paid_amount"])
    labelled = fill_unknown_trim(floored, BILLING_LABELS)
    status = F.when(F.col("claim_status") == "Rejected", "Denied").otherwise(F.col("claim_status"))
    return labelled.withColumn("claim_status", status).withColumns(
        {
            "claim_gap": (F.col("billed_amount") - F.col("paid_amount")).cast("decimal(14,2)"),
            "claim_approved": flag(F.col("claim_status") == "Paid"),
        }
    )


def clean_billing(raw: DataFrame) -> DataFrame:
    typed = _typed_once(raw, "billing_id", "billing", typed_billing)
    return apply_billing_rules(typed, fit_billing(typed))


def derive_claim_fields(df: DataFrame) -> DataFrame:
    """Ingest rule for new bills: the gap never goes below zero. Works on batch and streaming frames."""
    gap = F.col("billed_amount") - F.col("paid_amount")
    return df.withColumns(
        {
            "claim_gap": F.greatest(gap, F.lit(0)).cast("decimal(14,2)"),
            "claim_approved": flag(F.col("claim_status") == "Paid"),
        }
    )


def encounter_admission(encounter_id: Column) -> Column:
    """Admission id of a governed encounter key ``ENC<n>``."""
    return F.regexp_replace(encounter_id, "^ENC", "ADM")


def _linked(pairs: DataFrame, bill_columns: Sequence[str], method: str) -> DataFrame:
    kept = [c for c in bill_columns if c not in ("patient_id", "encounter_id", "claim_billing_date")]
    return pairs.select(
        *kept,
        F.coalesce(F.col("claim_billing_date"), F.col("discharge_date")).alias("claim_billing_date"),
        F.col("patient_id").alias("source_patient_id"),
        F.col("encounter_id").alias("source_encounter_id"),
        "admission_id",
        F.col("matched_patient_id").alias("patient_id"),
        F.when(F.col("admission_id").isNotNull(), method).alias("linkage_method"),
    )


def _link_targets(adm: DataFrame) -> DataFrame:
    return adm.select("admission_id", F.col("patient_id").alias("matched_patient_id"), "discharge_date")


def link_billing_to_admissions(bill: DataFrame, adm: DataFrame) -> DataFrame:
    """Surrogate link: the i-th bill goes to admission ``i mod N``, both in key order.

    Both positions come from a range partitioning; the join key spreads the bills evenly by construction.
    """
    targets = with_row_index(_link_targets(adm), ["admission_id"], "admission_positions", "slot")
    total = targets.agg(F.count("*").alias("n")).first()["n"]
    if total == 0:
        raise ValueError("cannot link bills: there are no admissions")
    bills = with_row_index(bill, ["billing_id"], "billing_positions", "position")
    pairs = bills.withColumn("slot", F.col("position") % F.lit(total)).join(targets, "slot")
    return _linked(pairs, bill.columns, SURROGATE_LINK)


PLACE = "place"  # where a bill is stored: next to its admission, or by its own id if it names none


def place_billing_by_encounter(bill: DataFrame, adm: DataFrame, partitions: int) -> DataFrame:
    """``link_billing_by_encounter`` with its rows left in ``partitions`` hash partitions of ``place``.

    ``place`` is the admission id wherever a bill is linked, so bills move once and are summed per admission where they are.
    """
    placed = bill.withColumn(PLACE, F.coalesce(encounter_admission(F.col("encounter_id")), "billing_id"))
    targets = _link_targets(adm).repartition(partitions, "admission_id")
    known = (F.col(PLACE) == targets["admission_id"]) & F.col("encounter_id").isNotNull()
    pairs = placed.repartition(partitions, PLACE).join(targets, known, "left")
    return _linked(pairs, placed.columns, GOVERNED_LINK)


def link_billing_by_encounter(
    bill: DataFrame, adm: DataFrame, key: Callable[[Column], Column] = encounter_admission
) -> DataFrame:
    """Governed link: ``key`` maps a bill's encounter to its admission.

    Every bill stays; one whose admission is unknown has a null admission, patient and linkage method. The
    bills are the streamed side of the join, so an admission with very many bills can be split.
    """
    targets = _link_targets(adm)
    pairs = bill.join(targets, key(F.col("encounter_id")) == targets["admission_id"], "left")
    return _linked(pairs, bill.columns, GOVERNED_LINK)


def linkage_summary(linked: DataFrame) -> DataFrame:
    """Bills and amounts per linkage method; ``unlinked`` counts bills without an admission."""
    return linked.groupBy(F.coalesce("linkage_method", F.lit("unlinked")).alias("linkage_method")).agg(
        F.count("*").alias("bills"), F.sum("billed_amount").alias("billed"), F.sum("paid_amount").alias("paid")
    )
