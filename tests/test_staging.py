"""Staged tables are written with few moves of the rows and small tasks, and hold what the plain operators give."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlens.functions import scale
from wardlens.operators import cleaning, features, warehouse
from wardlens.plans.catalog import QUERIES
from wardlens.sources import fixtures

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_placed_bills_are_the_linked_ones(spark, data):
    adm = data.admissions_clean.where("ward_type <> 'ICU'")
    number = F.regexp_extract("billing_id", r"BIL(\d+)", 1).cast("int")
    known = F.when(number % 3 != 0, F.col("encounter_id"))  # null, unknown and known encounters
    bills = data.billing_clean.withColumn("encounter_id", known)
    placed = cleaning.place_billing_by_encounter(bills, adm, 4)
    plain = cleaning.link_billing_by_encounter(bills, adm)
    assert rows_of(placed.drop(cleaning.PLACE)) == rows_of(plain)
    assert rows_of(warehouse.bill_sums(placed)) == rows_of(warehouse.bill_sums(plain))


def test_stored_bills_are_summed_where_they_are(data):
    assert "Exchange" not in plan_of(warehouse.bill_sums(data.placed_bills))


def test_stored_sums_give_the_billing_summary(data):
    plain = features.billing_summary(data.billing_linked).where("admission_id IS NOT NULL")
    same = [F.col(c).cast("double") if c in ("billed_sum", "paid_sum") else F.col(c) for c in plain.columns]
    assert rows_of(features.summary_of_sums(data.bill_sums).select(*same)) == rows_of(plain.select(*same))


def test_link_of_a_group_is_its_largest_method(spark):
    methods = [(1, "governed"), (1, None), (2, "governed"), (2, "surrogate"), (3, None)]
    methods = [(k, {"governed": features.GOVERNED_LINK, "surrogate": "~"}.get(m)) for k, m in methods]
    df = spark.createDataFrame(methods, "k int, linkage_method string")
    found = dict(df.groupBy("k").agg(features.governed_link()).collect())
    assert found == {1: features.GOVERNED_LINK, 2: None, 3: None}


def test_bills_are_combined_by_hash_and_moved_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(fixtures.raw_billing(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortAggregate" not in plan
    assert plan.count("hashpartitioning(l_orderkey") == 1


def test_smallest_label_of_repeated_lines(spark, tmp_path):
    lines = [(1, 1, "R", "O"), (1, 1, "N", "O"), (1, 2, "R", "F"), (1, 2, None, "F"), (1, 3, None, None), (1, 4, "A", "F"), (1, 4, "R", "F")]
    rows = [(k, n, "1995-01-01", f, s, 10.0) for k, n, f, s in lines]
    names = "l_orderkey long, l_linenumber long, l_shipdate string, l_returnflag string, l_linestatus string, l_extendedprice double"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 7)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(7, "M")], "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    found = {r["billing_id"]: r["claim_status"] for r in fixtures.raw_billing(spark, str(tmp_path)).collect()}
    assert found == {"BIL1-1": "Pending", "BIL1-2": "Denied", "BIL1-3": "Paid", "BIL1-4": "Paid"}


def test_task_sizes_of_the_session_stay(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "7m")
    try:
        scale.bound_tasks(spark)
        assert spark.conf.get(name) == "7m"
        spark.conf.unset(name)
        scale.bound_tasks(spark)
        assert spark.conf.get(name) == scale.TASK_BYTES[name]
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_landing_bills_are_not_gathered(spark, data, monkeypatch):
    def gathered(*_):
        raise AssertionError("all bills in one task")

    monkeypatch.setattr(type(data.billing_clean), "coalesce", gathered)
    found = QUERIES["ingest_keyed_bills"](spark, SF)
    assert found.count() == data.billing_clean.count() == found.select("billing_id").distinct().count()


def test_only_repeated_keys_move_before_the_first_row_is_kept(spark, monkeypatch):
    """Extracts without repeats are stored once and not sorted by key; repeats, null keys too, give the same first rows."""
    rows = [(f"K{n % 40}" if n % 7 else None, n % 11, f"v{n}") for n in range(50)] + [("U1", 1, "a"), ("U2", 2, "b")]
    raw = spark.createDataFrame(rows, "k string, o int, v string")
    plain = rows_of(cleaning.drop_duplicate_keys(raw, "k", ["o", "v"]))
    for most in (100, 0):
        monkeypatch.setattr(cleaning, "MOST_REPEATED", most)
        first, stored = cleaning.first_rows(raw, "k", "some")
        assert rows_of(first) == plain and not stored
    bills = fixtures.raw_billing(spark, SF)
    adm = fixtures.raw_admissions(spark, SF)
    wanted = [rows_of(cleaning.typed_billing(bills)), rows_of(cleaning.typed_admissions(adm))]
    monkeypatch.setattr(cleaning, "drop_duplicate_keys", None)  # no row is left for it
    clean = cleaning.clean_billing(bills)
    assert "Exchange" not in plan_of(clean) and clean.count() == len(wanted[0])
    assert cleaning.clean_admissions(adm).count() == len(wanted[1])
    typed = cleaning._typed_once(bills, "billing_id", "billing", cleaning.typed_billing)
    assert rows_of(typed) == wanted[0]
