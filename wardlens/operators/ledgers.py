"""Stored visits and bills that a report of one month or one patient can skip through.

Both are folders of months with their rows in patient order. A month's report reads that month's folder. A patient's report reads, of each
month, the row groups whose range and Bloom filter may hold the patient; within them the page index skips on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.config import DEPARTMENTS
from wardlens.functions.columns import position_in
from wardlens.functions.scale import new_path

VISIT_MONTH, BILL_MONTH = "visit_month", "bill_month"
PATIENTS_PER_FILE = 200_000  # different patients that a Bloom filter is made for


def month_number(day: Column) -> Column:
    """The month of a date as the number yyyymm."""
    return F.year(day) * 100 + F.month(day)


def visit_rows(feat: DataFrame) -> DataFrame:
    """One row per admission with the patient, the department and the clinical facts next to it."""
    return feat.select(
        "patient_id", "age", "gender", "admission_id", "admit_date", "discharge_date", "department",
        position_in(DEPARTMENTS, F.col("department")).alias("department_id"), "doctor_id", "disease_severity_score",
        "lab_abnormality_score", "medicine_code", F.round("medicine_count").cast("int").alias("medicine_count"),
        F.round("los_days").cast("int").alias("los_days"), "waiting_time_minutes",
        F.round("readmitted_30d").cast("int").alias("readmitted_30d"),
    )


def bill_rows(bills: DataFrame) -> DataFrame:
    return bills.select(
        "patient_id", "admission_id", "billing_id", "claim_billing_date", "billed_amount", "paid_amount", "claim_status"
    )


def write_ledger(rows: DataFrame, name: str, month: str, day: str) -> DataFrame:
    """Write ``rows`` by the month of ``day``, sorted by patient, and read them back. Rows without a day have a month of their own.

    Months are spread over tasks by their size, so a large month is several files, each of them in patient order.
    """
    spark = rows.sparkSession
    path = new_path(spark, name)
    monthly = rows.withColumn(month, F.coalesce(month_number(F.col(day)), F.lit(0)))
    placed = monthly.hint("rebalance", month).sortWithinPartitions(month, "patient_id")
    (
        placed.write.partitionBy(month)
        .option("parquet.bloom.filter.enabled#patient_id", "true")
        .option("parquet.bloom.filter.expected.ndv#patient_id", str(PATIENTS_PER_FILE))
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )
    return spark.read.schema(monthly.schema).parquet(path)


def visit_ledger(feat: DataFrame, sums: DataFrame) -> DataFrame:
    """The visits with their bill totals; both inputs are bucketed by admission, so the join needs no exchange."""
    totals = sums.select("admission_id", "fan", "paid")
    return write_ledger(visit_rows(feat).join(totals, "admission_id", "left"), "visit_ledger", VISIT_MONTH, "admit_date")


def bill_ledger(bills: DataFrame) -> DataFrame:
    return write_ledger(bill_rows(bills), "bill_ledger", BILL_MONTH, "claim_billing_date")
