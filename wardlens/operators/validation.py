"""Profiles and raw-data rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.config import VALID_CLAIM_STATUSES
from wardlens.functions.columns import flag
from wardlens.functions.scale import beside, exact_quantiles


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _repeats(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Rows beyond the first of each group of equal values; nulls count as equal.

    Copies are counted with a partial count per task, so many copies of one row travel as one record.
    """
    groups = df.groupBy(*columns).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(name))


def _missing(df: DataFrame) -> Column:
    nulls = [F.col(c).isNull().cast("bigint") for c in df.columns]
    return F.coalesce(F.sum(reduce(Column.__add__, nulls)), F.lit(0))


def profile_dataset(df: DataFrame, keys: Sequence[str], name: str = "dataset") -> DataFrame:
    size = df.agg(
        F.lit(name).alias("dataset"),
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        _missing(df).alias("missing_cells"),
    )
    return beside(size, _repeats(df, df.columns, "duplicate_rows"), _repeats(df, keys, "duplicate_keys"))


def validate_raw(adm: DataFrame, bill: DataFrame) -> DataFrame:
    return profile_dataset(adm, ["admission_id"], "admissions").unionByName(
        profile_dataset(bill, ["billing_id", "claim_id"], "billing")
    )


def _date(column: str) -> Column:
    return F.try_to_timestamp(F.col(column).cast("string"), F.lit("yyyy-MM-dd")).cast("date")


def _fails(condition: Column, unknown_fails: bool = False) -> Column:
    return F.sum(F.coalesce(condition, F.lit(unknown_fails)).cast("bigint"))


def rule_failures(adm: DataFrame, bill: DataFrame) -> DataFrame:
    """Failed rows per business rule. An unreadable stay or an unknown status fails; an unreadable date does not."""
    los = F.col("los_days").try_cast("double")
    paid, billed = (F.col(c).try_cast("decimal(14,2)") for c in ("paid_amount", "billed_amount"))
    adm_rules = {
        "Admissions: discharge_date >= admit_date": _fails(_date("discharge_date") < _date("admit_date")),
        "Admissions: los_days between 0 and 90": _fails(~los.between(0, 90), unknown_fails=True),
    }
    bill_rules = {
        "Billing: billed_amount >= paid_amount": _fails(paid > billed),
        "Billing: valid claim status": _fails(~F.col("claim_status").isin(*VALID_CLAIM_STATUSES), unknown_fails=True),
    }
    parts = []
    for df, rules in ((adm, adm_rules), (bill, bill_rules)):
        totals = df.agg(*[F.coalesce(e, F.lit(0)).alias(r) for r, e in rules.items()])
        parts.append(totals.unpivot([], list(rules), "rule", "failed_rows"))
    unique = [
        _repeats(df, [key], "failed_rows").select(F.lit(f"Unique {key}").alias("rule"), "failed_rows")
        for df, key in ((adm, "admission_id"), (bill, "billing_id"))
    ]
    return _union(parts + unique)


def missing_by_column(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column_name", "missing_count")


def quality_comparison(pairs: Mapping[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Raw against clean per data set; each value is (raw, clean, key)."""
    rows = []
    for name, (raw, clean, key) in pairs.items():
        before = raw.agg(F.count("*").alias("raw_rows"), _missing(raw).alias("raw_missing"))
        after = clean.agg(F.count("*").alias("clean_rows"), _missing(clean).alias("clean_missing"))
        left = _repeats(clean, [key], "duplicate_keys_after")
        rows.append(beside(before, after, left).withColumn("dataset", F.lit(name)))
    return _union(rows)


def table_quality(wh: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [
            beside(
                df.agg(
                    F.lit(name).alias("table_name"),
                    F.count("*").alias("rows"),
                    F.lit(len(df.columns)).alias("columns"),
                    _missing(df).alias("missing_cells"),
                ),
                _repeats(df, df.columns, "duplicate_rows"),
            )
            for name, df in wh.items()
        ]
    )


def cardinality_violations(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Keys that break ``many_to_one`` or ``one_to_one``, with their side and row count."""
    sides = {"many_to_one": {"right": right}, "one_to_one": {"left": left, "right": right}}
    if how not in sides:
        raise ValueError(f"unknown cardinality {how!r}")
    return _union(
        [
            df.groupBy(*on).agg(F.count("*").alias("rows")).where("rows > 1").withColumn("side", F.lit(side))
            for side, df in sides[how].items()
        ]
    )


def assert_join_cardinality(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> None:
    example = cardinality_violations(left, right, on, how).first()
    if example is not None:
        raise ValueError(f"join is not {how} on {list(on)}: {example.asDict()}")


def describe_table(df: DataFrame) -> DataFrame:
    """One row per column: count, distinct, most frequent value, and the spread of numeric columns."""
    numeric = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint") or t.startswith("decimal")]
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    values = text.unpivot([], list(df.columns), "column_name", "value").where("value IS NOT NULL")
    # Counted per value first, so a very frequent value is combined before the shuffle.
    counted = values.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    top = F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("value"))).alias("top")
    shape = counted.groupBy("column_name").agg(F.sum("n").alias("count"), F.count("*").alias("unique"), top).select(
        "column_name", "count", "unique", F.col("top.value").alias("top"), (-F.col("top.n")).alias("freq")
    )
    if not numeric:
        return shape
    spread = df.agg(
        *[
            F.struct(
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.stddev_samp(F.col(c).cast("double")).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in numeric
        ]
    )
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in numeric})
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"`{c}`.mean").alias("mean"), F.col(f"`{c}`.std").alias("std"),
            F.col(f"`{c}`.min").alias("min"),
            *[F.lit(q).cast("double").alias(n) for n, q in zip(("q25", "q50", "q75"), quartiles[c])],
            F.col(f"`{c}`.max").alias("max"),
        )
        for c in numeric
    ]
    return shape.join(spread.select(F.inline(F.array(*rows))), "column_name", "left")
