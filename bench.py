"""Wall seconds of the pipeline stages and headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_SHARED_DIR (folder for
written stages, removed at the end; a new temporary folder by default, as the bench runs on one machine).
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from wardlens.functions.scale import remove_intermediates
from wardlens.plans.catalog import QUERIES
from wardlens.plans.dataset import open_fixture

STAGES = ("admissions_clean", "billing_linked", "features", "warehouse", "marts")
HEADLINES = (
    "clean_admissions", "clean_billing", "link_billing_to_admissions", "winsorize_iqr", "feature_billing_category",
    "vw_executive_kpis", "vw_department_kpis", "vw_doctor_utilization", "vw_monthly_revenue", "vw_daily_occupancy",
    "vw_patient_360", "billing_claims", "q10_quarterly_admissions_growth", "q13_claim_success_by_insurer",
    "q17_patient_revisit_frequency", "q19_readmission_by_ward", "q27_severity_by_department",
    "q31_top_patients_by_revenue", "q37_high_risk_departments", "q41_wait_percentile_in_department",
    "q42_multi_risk_patients", "q46_readmission_gaps", "q55_readmission_by_age_group", "q57_largest_unpaid_claims",
    "q59_los_bucket_and_paid", "historical_occupancy", "latest_snapshot", "emergency_forecast", "monthly_activity",
    "payer_summary", "doctor_performance", "latest_encounter", "risk_class", "correlation_matrix",
    "measures_by_department", "check_primary_keys", "check_foreign_keys", "classification_metrics", "occupancy_models",
    "occupancy_forecast", "monthly_operations_report", "patient_360_report", "dataset_fingerprint", "train_waiting",
    "waiting_scenario",
)


def drain(df: DataFrame) -> None:
    """Compute every row and column without keeping the result."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wardlens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    timings: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        timings[name] = round(time.perf_counter() - start, 3)

    data = open_fixture(spark, sf_dir)
    for stage in STAGES:
        timed(f"stage_{stage}", lambda s=stage: getattr(data, s))
    for name in HEADLINES:
        timed(name, lambda n=name: drain(QUERIES[n](spark, sf_dir)))
    remove_intermediates(spark)
    print(
        json.dumps(
            {
                "metric": "pipeline stages and headline queries, total wall time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
