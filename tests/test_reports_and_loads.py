"""Data skipping of reports, one scan per table, salted joins, repeated loads and keyed ingest."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from wardlens.functions import scale
from wardlens.operators import ledgers, views
from wardlens.plans import catalog
from wardlens.sources import loads, sinks
from wardlens.streaming import ingest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def plain_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_read(df):
    """Rows that the file scans of a computed frame produced."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    total = 0
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if "FileScan" in leaf.toString() or "Scan parquet" in leaf.nodeName():
            total += leaf.metrics().apply("numOutputRows").value()
    return total


def test_all_visits_read_features_and_bills_once(data, plain_plans):
    wh = data.warehouse
    assert wh.visit_lines is not None
    scans = re.findall(r"FileScan parquet .*?Location: \S+ \[[^\]]*\]", plan_of(views.patient_360(wh)).replace("\n", " "))
    folders = [re.search(r"\[file:([^,\]]*)", s).group(1) for s in scans]
    features, bills = (data.features.inputFiles()[0], data.billing_linked.inputFiles()[0])
    for file in (features, bills):
        folder = file.removeprefix("file://").rsplit("/", 1)[0]
        assert sum(folder.endswith(f.rstrip(".").rsplit("/", 1)[-1]) or f.startswith(folder) or folder.startswith(f.rstrip(".")) for f in folders) <= 1


def test_a_month_reads_its_folder(data, plain_plans):
    report = views.monthly_operations_report(data.warehouse, 1998, 3)
    plan = plan_of(report)
    assert re.search(r"PartitionFilters: \[[^\]]*visit_month[^\]]*199803", plan)
    assert plan.count("FileScan") == 1 and "Join" not in plan
    chosen = data.features.where("admit_date between date'1998-03-01' and date'1998-03-31'").count()
    assert 0 < rows_read(views.monthly_operations_report(data.warehouse, 1998, 3)) == chosen < data.features.count()


def test_a_patient_reads_few_rows(data, plain_plans):
    wh = data.warehouse
    report = views.patient_360(wh, "PAT7")
    assert "PushedFilters: [IsNotNull(patient_id), EqualTo(patient_id,PAT7)]" in plan_of(report)
    everything = data.features.count() + data.billing_linked.count()
    assert rows_read(views.patient_360(wh, "PAT7")) < everything / 4
    assert rows_read(views.patient_360(wh, "PAT-unknown")) < everything / 100


def test_ledgers_hold_all_rows(data):
    visits, bills = data.ledgers
    assert visits.count() == data.features.count() and bills.count() == data.billing_linked.count()
    assert visits.where(F.col(ledgers.VISIT_MONTH) != ledgers.month_number(F.col("admit_date"))).count() == 0
    assert data.ledgers[0] is visits


def test_reports_of_replaced_tables_follow_them(data):
    """Without the stored shortcuts the same reports come from the tables."""
    wh = data.warehouse
    replaced = wh.with_tables({"admissions": wh["admissions"], "billing": wh["billing"]})
    assert replaced.visit_lines is None and replaced.ledgers is None and replaced.bill_lines is None
    for make in (
        lambda w: views.patient_360(w), lambda w: views.patient_360(w, "PAT7"), lambda w: views.monthly_operations_report(w, 1998, 3),
    ):
        assert sorted(map(repr, make(wh).collect())) == sorted(map(repr, make(replaced).collect()))
    fewer = wh.with_tables({"admissions": wh["admissions"].where("ward_type <> 'ICU'")})
    assert views.patient_360(fewer).where("admission_id IS NOT NULL").count() < views.patient_360(wh).count()


@pytest.mark.parametrize("hot_rows", [1, 7, 1000])
def test_salted_left_join(spark, hot_rows):
    one = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("none", 4), (None, 5)], "k string, x int")
    many = spark.createDataFrame([("a", y) for y in range(60)] + [("a", 1)] * 5 + [("b", -1), ("lost", 0), (None, 9)], "k string, y int")
    found = scale.left_join_salted(one, many, "k", hot_rows=hot_rows)
    assert sorted(map(repr, found.select("k", "x", "y").collect())) == sorted(map(repr, one.join(many, "k", "left").collect()))
    sizes = many.groupBy("k").agg(F.count("*").alias("n"))
    assert scale.left_join_salted(one, many, "k", sizes, hot_rows).count() == 65 + 2 + 1 + 1


def tables_of(data, where="true"):
    wh = data.warehouse
    return {"doctors": wh["doctors"], "admissions": wh["admissions"].where(where)}


def test_a_load_adds_only_new_keys(spark, data, tmp_path):
    target = loads.LoadedWarehouse(spark, str(tmp_path))
    assert target.read("admissions") is None
    part = data.warehouse["admissions"].where("ward_type = 'ICU'").count()
    first = {r["table_name"]: r for r in target.load(tables_of(data, "ward_type = 'ICU'"), "one").collect()}
    assert first["admissions"]["added_rows"] == part == target.read("admissions").count()
    second = {r["table_name"]: r for r in target.load(tables_of(data), "two").collect()}
    total = data.warehouse["admissions"].count()
    assert (second["admissions"]["already_there"], second["admissions"]["stored_rows"]) == (part, total)
    assert second["doctors"]["added_rows"] == 0
    stored = target.read("admissions").drop("load")
    assert stored.count() == total and stored.exceptAll(data.warehouse["admissions"]).count() == 0
    assert list(target.committed()) == ["one", "two"]


@pytest.mark.parametrize("dies_at", ["doctors", "admissions"])
def test_a_load_that_died_is_invisible_and_can_be_repeated(spark, data, tmp_path, dies_at):
    target = loads.LoadedWarehouse(spark, str(tmp_path))

    def dying(df, path):
        loads.write_parquet(df, path)
        if f"/{dies_at}/" in path:
            raise InterruptedError

    with pytest.raises(InterruptedError):
        target.load(tables_of(data), "one", dying)
    assert not target.committed() and target.read("doctors") is None
    target.load(tables_of(data, "ward_type = 'ICU'"), "other")
    report = {r["table_name"]: r for r in target.load(tables_of(data), "one").collect()}
    assert report["admissions"]["stored_rows"] == data.warehouse["admissions"].count() == target.read("admissions").count()
    again = target.load(tables_of(data), "one").collect()
    assert {r["table_name"]: r for r in again} == report


def test_composite_and_null_keys(spark, tmp_path):
    target = loads.LoadedWarehouse(spark, str(tmp_path))
    rows = spark.createDataFrame([("a", "m1", 1), ("a", "m2", 2), (None, "m1", 3)], "admission_id string, medicine_code string, medicine_count int")
    target.load({"medicines": rows}, "one")
    more = rows.unionByName(spark.createDataFrame([("b", "m1", 4)], rows.schema))
    report = target.load({"medicines": more}, "two").first()
    assert (report["added_rows"], report["already_there"], report["stored_rows"]) == (1, 3, 4)


def test_a_first_load_makes_its_source_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def seen(n):
        made.add(1)
        return True

    rows = spark.createDataFrame([(f"a{n}", "m", n) for n in range(40)], "admission_id string, medicine_code string, medicine_count int")
    target = loads.LoadedWarehouse(spark, str(tmp_path))
    report = target.load({"medicines": rows.where(F.udf(seen, "boolean")("medicine_count"))}, "one").first()
    assert (report["source_rows"], report["added_rows"], report["stored_rows"]) == (40, 40, 40)
    assert made.value == 40


def test_the_bills_to_leave_out_are_found_once(data, monkeypatch):
    written = []
    monkeypatch.setattr(catalog, "materialize_small", lambda df, name: written.append(name) or scale.materialize_small(df, name))
    tables = catalog._without_icu(data)
    assert written == ["lost_bills"]
    wh = data.warehouse
    icu = wh["admissions"].where("ward_type = 'ICU'")
    kept = wh["billing"].join(icu, "admission_id", "left_anti").count()
    assert tables["billing"].count() == tables["claims"].count() == kept < wh["billing"].count()


BILL = "billing_id string, claim_status string, billed_amount decimal(14,2), paid_amount decimal(14,2)"


def drop_files(spark, landing, rows):
    spark.createDataFrame(rows, BILL).coalesce(1).write.mode("append").parquet(landing)


def test_a_bill_that_arrives_again_is_stored_once(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "stored", "checkpoint"))
    schema = spark.createDataFrame([], BILL).schema

    def stream(within="7 days"):
        arriving = ingest.arriving_bills(spark, landing, schema, 1)
        ingest.ingest_keyed_bills(arriving, target, checkpoint, within=within).awaitTermination()
        return sorted((r["billing_id"], float(r["claim_gap"]), r["claim_approved"]) for r in ingest.stored_bills(spark, target).collect())

    from decimal import Decimal as D

    drop_files(spark, landing, [("b1", "Paid", D(10), D(8)), ("b1", "Paid", D(10), D(8)), (None, "Paid", D(1), D(1))])
    drop_files(spark, landing, [("b2", "Denied", D(5), D(7)), ("b1", "Denied", D(10), D(0))])
    assert stream() == [("b1", 2.0, 1), ("b2", 0.0, 0)]
    drop_files(spark, landing, [("b3", "Paid", D(4), D(4)), ("b2", "Paid", D(5), D(5))])
    assert stream() == [("b1", 2.0, 1), ("b2", 0.0, 0), ("b3", 0.0, 1)]


def test_repeats_beyond_the_state_are_left_out_by_their_key(spark, tmp_path):
    from decimal import Decimal as D

    schema = spark.createDataFrame([], BILL).schema
    target = str(tmp_path / "stored")
    for n in range(2):  # a stream that forgot everything: a new checkpoint over the same files and one more
        drop_files(spark, str(tmp_path / "landing"), [("b1", "Paid", D(10), D(8)), (f"n{n}", "Paid", D(1), D(1))])
        arriving = ingest.arriving_bills(spark, str(tmp_path / "landing"), schema, 1).where(F.lit(True))
        if n == 0:
            ingest.ingest_keyed_bills(arriving, target, str(tmp_path / "checkpoint")).awaitTermination()
    known = ingest.stored_bills(spark, target).count()
    assert known == 2
    ingest.ingest_keyed_bills(arriving, target, str(tmp_path / "checkpoint"), within="1 second").awaitTermination()
    assert sorted(r["billing_id"] for r in ingest.stored_bills(spark, target).collect()) == ["b1", "n0", "n1"]


def test_registered_loads_cover_all_tables(spark):
    rows = catalog.QUERIES["load_appended"](spark, SF).collect()
    assert [r["table_name"] for r in sorted(rows, key=lambda r: r["load_order"])] == list(sinks.LOAD_ORDER)
