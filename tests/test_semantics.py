"""Small hand-made cases for rules whose edges matter."""

from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from conftest import SF
from pyspark.sql import functions as F

from wardlens.functions import columns as C
from wardlens.operators import cleaning, contracts, marts, reports, validation, views
from wardlens.operators.features import feature_provenance


def one(df):
    return df.first()[0]


def test_age_bands_are_closed_on_the_right(spark):
    ages = [0, 18, 19, 35, 36, 50, 51, 65, 66, 120, 121]
    found = [r[0] for r in spark.createDataFrame([(a,) for a in ages], "a int").select(C.age_band(F.col("a"))).collect()]
    expected = pd.cut(ages, [0, 18, 35, 50, 65, 120], labels=["0-18", "19-35", "36-50", "51-65", "66+"], include_lowest=True)
    assert found == [str(v) for v in expected]


def test_half_even_rounding(spark):
    values = [0.5, 1.5, 2.5, 26.5, -0.5]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(C.half_even(F.col("v")))
    assert [r[0] for r in df.collect()] == [round(v) for v in values]


def test_percent_text_rounds_ties_to_even(spark):
    assert one(spark.range(1).select(C.percent_text(F.lit(0.1125)))) == f"{0.1125:.1%}"


def test_null_comparison_counts_as_zero(spark):
    assert one(spark.createDataFrame([(None,)], "x double").select(C.flag(F.col("x") > 7))) == 0


def test_stable_int_known_value(spark):
    assert one(spark.range(1).select(C.stable_int(F.lit("abc"), 2**31))) == 2416005272 % 2**31


def test_season_per_month(spark):
    months = spark.range(1, 13).select(C.season(F.col("id").cast("int")))
    names = ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]
    assert [r[0] for r in months.collect()] == names


def test_rare_flag_is_not_winsorized(spark):
    df = spark.createDataFrame([(float(i == 0), float(i)) for i in range(20)] + [(0.0, 500.0)], "flag double, v double")
    out = cleaning.winsorize_iqr(df, ["flag", "v"]).toPandas()
    q1, q3 = df.toPandas()["v"].quantile([0.25, 0.75])
    assert out["flag"].sum() == 1.0
    assert out["v"].max() == pytest.approx(q3 + 1.5 * (q3 - q1))


def test_unreadable_values_become_null_then_median(spark):
    df = spark.createDataFrame([("1",), ("n/a",), ("3",), (None,), ("8",)], "v string")
    out = cleaning.impute_median(cleaning.to_numbers(df, ["v"]), ["v"])
    assert sorted(r[0] for r in out.collect()) == [1.0, 3.0, 3.0, 3.0, 8.0]


def test_day_first_dates(spark):
    df = spark.createDataFrame([("03/04/2020",), ("2020-04-03",), ("31/02/2020",), ("x",)], "d string")
    found = [r[0] for r in cleaning.coerce_dates(df, ["d"], dayfirst=True).collect()]
    assert found == [dt.date(2020, 4, 3), dt.date(2020, 4, 3), None, None]


def test_gap_floor_differs_between_cleaning_and_ingest(spark):
    bill = spark.createDataFrame(
        [("B1", None, "P", "E", "01/02/2020", None, "Cash", "Rejected", "10.00", "12.50")],
        "billing_id string, claim_id string, patient_id string, encounter_id string, claim_billing_date string, "
        "insurance_provider string, payment_method string, claim_status string, billed_amount string, paid_amount string",
    )
    clean = cleaning.clean_billing(bill)
    row = clean.first()
    assert (float(row["claim_gap"]), row["claim_status"], row["insurance_provider"]) == (-2.5, "Denied", "Unknown")
    assert float(cleaning.derive_claim_fields(clean).first()["claim_gap"]) == 0.0


def test_rules_count_missing_values(spark):
    adm = spark.createDataFrame(
        [("A", "2020-01-05", "2020-01-01", "95"), ("B", "2020-01-05", None, "x"), ("B", "bad", "2020-01-01", "4")],
        "admission_id string, admit_date string, discharge_date string, los_days string",
    )
    bill = spark.createDataFrame(
        [("1", "5", "9", "Paid"), ("2", None, "9", None)],
        "billing_id string, billed_amount string, paid_amount string, claim_status string",
    )
    found = {r["rule"]: r["failed_rows"] for r in validation.rule_failures(adm, bill).collect()}
    assert found == {
        "Admissions: discharge_date >= admit_date": 1,
        "Admissions: los_days between 0 and 90": 2,
        "Billing: billed_amount >= paid_amount": 1,
        "Billing: valid claim status": 1,
        "Unique admission_id": 1,
        "Unique billing_id": 0,
    }


def stays(spark, rows):
    return spark.createDataFrame(
        [(i, dt.date.fromisoformat(a), d and dt.date.fromisoformat(d)) for i, (a, d) in enumerate(rows)],
        "admission_id int, admit_date date, discharge_date date",
    )


def test_census_forms(spark):
    df = stays(
        spark,
        [("2020-01-01", "2020-01-03"), ("2020-01-02", None), ("2020-01-05", "2020-01-04"), ("2020-01-08", "2020-01-08")],
    )
    observed = {str(r["admit_date"]): r["occupied_beds"] for r in views.daily_occupancy({"admissions": df}).collect()}
    # The stay that ends before it starts covers no day; the open stay never leaves.
    assert observed == {"2020-01-01": 1, "2020-01-02": 2, "2020-01-05": 1, "2020-01-08": 2}
    dense = marts.historical_occupancy(df).toPandas()
    assert len(dense) == 8 and list(dense["occupied_beds"])[:4] == [1, 2, 2, 1]


def test_census_forms_agree_on_the_fixture(spark, data):
    sweep = views.daily_occupancy(data.warehouse).select("admit_date", F.col("occupied_beds").alias("a"))
    dense = marts.historical_occupancy(data.features).select(F.col("date").alias("admit_date"), F.col("occupied_beds").alias("b"))
    assert sweep.join(dense, "admit_date").where("a <> b").count() == 0
    plain = data.warehouse["admissions"].select("admit_date", "discharge_date").toPandas()
    for row in sweep.sample(0.02, seed=3).collect():
        inside = (plain["admit_date"] <= row["admit_date"]) & (plain["discharge_date"] >= row["admit_date"])
        assert inside.sum() == row["a"]


def test_average_rank_share_equals_pandas(spark):
    values = [3.0, 1.0, 3.0, 2.0, 3.0, 1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    found = df.withColumn("r", reports.average_rank_share("v")).orderBy("i").toPandas()["r"]
    assert list(found) == pytest.approx(list(pd.Series(values).rank(pct=True)))


def test_doctor_alias(spark):
    ids = spark.createDataFrame([("DOC001",), ("DOC010",), ("DOC011",), ("X",)], "d string")
    found = [r[0] for r in ids.select(reports.doctor_alias(F.col("d"))).collect()]
    assert found == ["Dr. A. Sharma · Team 1", "Dr. D. Gupta · Team 1", "Dr. A. Sharma · Team 2", "Dr. A. Sharma · Team 1"]


def test_risk_segments_equal_qcut(spark, data):
    scores = data.features.select("risk_score").toPandas()["risk_score"]
    expected = pd.qcut(scores, 3, labels=["Low", "Medium", "High"]).value_counts().to_dict()
    assert {r["risk_group"]: r["patients"] for r in reports.risk_segmentation(data.features).collect()} == expected


def test_empty_months_appear(spark):
    df = stays(spark, [("2020-01-15", None), ("2020-03-02", None)]).selectExpr(
        "admission_id", "admit_date", "'P' AS patient_id", "0.0D AS readmitted_30d", "2.0D AS los_days"
    )
    rows = reports.monthly_activity(df).collect()
    assert [(str(r["month_start"]), r["admissions"], r["readmission_rate"]) for r in rows] == [
        ("2020-01-01", 1, 0.0), ("2020-02-01", 0, None), ("2020-03-01", 1, 0.0),
    ]


def test_shares_sum_to_one(data):
    from wardlens.operators.analyses import ANALYSES

    for name, column in (
        ("q48_department_revenue_share", "revenue_share"), ("q49_admission_mix", "admission_share"), ("q50_ward_mix", "ward_share"),
    ):
        assert one(ANALYSES[name](data.warehouse).agg(F.sum(column))) == pytest.approx(1.0)


def test_thresholds_are_parameters(data):
    from wardlens.operators.analyses import high_occupancy_days, high_readmission_doctors

    assert high_readmission_doctors(data.warehouse, 1).count() == 40
    assert high_occupancy_days(data.warehouse, 101).count() == 0


def test_contracts_fail_on_damage(spark, data):
    wh = data.warehouse
    broken = wh.with_tables({"admissions": wh["admissions"].union(wh["admissions"].limit(1))})
    status = {r["check"]: r["status"] for r in contracts.check_primary_keys(broken).collect()}
    assert status["table:admissions"] == "failed" and status["table:billing"] == "passed"
    lost = wh.with_tables({"doctors": wh["doctors"].limit(1)})
    status = {r["check"]: r["status"] for r in contracts.check_foreign_keys(lost).collect()}
    assert status["foreign_key:admissions.doctor_id"] == "failed"
    late = wh["admissions"].withColumn("discharge_date", F.date_sub("admit_date", 1))
    assert contracts.check_admission_dates({"admissions": late}).first()["status"] == "failed"
    old = data.marts["command_center_kpis"].withColumn("as_of_date", F.lit("1990-01-01").cast("date"))
    checks = contracts.check_mart_consistency(wh, {**data.marts, "command_center_kpis": old}).collect()
    assert {r["check"] for r in checks if r["status"] == "failed"} == {"consistency:as_of_date"}


def test_contracts_pass_on_the_fixture(spark, data):
    from wardlens.plans.catalog import QUERIES

    assert {r["status"] for r in QUERIES["validate"](spark, SF).collect()} == {"passed"}


def test_fingerprint_ignores_order_and_sees_changes(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "i int, s string")
    same = contracts.dataset_fingerprint(a.orderBy(F.desc("i")).select("s", "i")).first()
    other = contracts.dataset_fingerprint(a.withColumn("s", F.upper("s"))).first()
    assert contracts.dataset_fingerprint(a).first() == same != other


def test_cardinality_check(spark):
    left = spark.createDataFrame([(1,), (1,)], "k int")
    right = spark.createDataFrame([(1,)], "k int")
    validation.assert_join_cardinality(left, right, ["k"], "many_to_one")
    with pytest.raises(ValueError, match="one_to_one"):
        validation.assert_join_cardinality(left, right, ["k"], "one_to_one")


def test_provenance_lists_known_features(spark, data):
    rows = feature_provenance(spark).collect()
    assert {r["provenance"] for r in rows} == set(contracts.PROVENANCE_KINDS)
