from __future__ import annotations

import pytest
from conftest import SF

from wardlens.operators import cleaning
from wardlens.sources import fixtures, readers, sinks
from wardlens.streaming.ingest import ingest_bills


def test_raw_csv_round_trip(spark, tmp_path):
    for name, df in (("admissions", fixtures.dirty_admissions(spark, SF)), ("billing", fixtures.dirty_billing(spark, SF))):
        df.write.option("header", True).csv(str(tmp_path / readers.RAW_FILES[name]))
    adm, bill = readers.read_raw(spark, str(tmp_path))
    assert set(t for _, t in adm.dtypes) == {"string"}
    assert cleaning.clean_admissions(adm).count() == fixtures.raw_admissions(spark, SF).count()
    assert cleaning.clean_billing(bill).exceptAll(cleaning.clean_billing(fixtures.dirty_billing(spark, SF))).count() == 0


def test_raw_csv_needs_its_columns(spark, tmp_path):
    for file in readers.RAW_FILES.values():
        spark.createDataFrame([("1",)], "admission_id string").write.option("header", True).csv(str(tmp_path / file))
    with pytest.raises(ValueError, match="lacks the columns"):
        readers.read_raw(spark, str(tmp_path))


def test_table_lookup_order(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    with pytest.raises(FileNotFoundError):
        readers.read_table(spark, str(tmp_path), "t")
    df.write.parquet(str(tmp_path / "t"))
    assert readers.read_table(spark, str(tmp_path), "t").first() == (1, "a")
    df.unionAll(df).write.option("header", True).option("compression", "gzip").csv(str(tmp_path / "t.csv.gz"))
    assert readers.read_table(spark, str(tmp_path), "t").count() == 2


def test_warehouse_is_stored_by_year(spark, data, tmp_path):
    sinks.write_warehouse({n: data.warehouse[n] for n in ("departments", "admissions")}, str(tmp_path))
    stored = sinks.read_warehouse(spark, str(tmp_path), ["admissions"])["admissions"]
    assert stored.count() == data.warehouse["admissions"].count()
    plan = stored.where("admit_year = 1998")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(admit_year" in plan


def test_load_reports_counts_and_order(data, tmp_path):
    tables = {n: data.warehouse[n] for n in ("billing", "departments", "insurance")}
    rows = sinks.load_in_fk_order(tables, sinks.folder_sink(str(tmp_path))).collect()
    assert [r["table_name"] for r in rows] == ["departments", "insurance", "billing"]
    assert {r["status"] for r in rows} == {"matched"}


def test_missing_tables_are_listed(data):
    rows = {r["table_name"]: r["rows"] for r in sinks.table_counts({"departments": data.warehouse["departments"]}).collect()}
    assert rows["departments"] == 8 and rows["claims"] is None and len(rows) == 12


def test_streamed_bills_get_the_ingest_rule(spark, tmp_path):
    source = cleaning.clean_billing(fixtures.raw_billing(spark, SF)).drop("claim_gap", "claim_approved")
    source.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    ingest_bills(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out"))
    expected = cleaning.derive_claim_fields(source)
    assert stored.select(expected.columns).exceptAll(expected).count() == 0 and stored.count() == source.count()


def test_part_files_in_another_order_are_refused(spark, tmp_path):
    folder = tmp_path / readers.RAW_FILES["admissions"]
    folder.mkdir()
    columns = list(fixtures.dirty_admissions(spark, SF).columns)
    for n, order in enumerate((columns, columns[::-1])):
        (folder / f"part-{n}.csv").write_text(",".join(order) + "\n" + ",".join(f"v_{c}" for c in order) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers._extract(spark, str(folder), tuple(columns)).collect()


def test_csv_tables_keep_leading_zeros(spark, tmp_path):
    spark.createDataFrame([("007", 1)], "id string, n int").write.option("header", True).csv(str(tmp_path / "t.csv"))
    assert readers.read_table(spark, str(tmp_path), "t").first() == ("007", "1")
    typed = readers.read_table(spark, str(tmp_path), "t", spark.createDataFrame([], "id string, n int").schema)
    assert typed.first() == ("007", 1)


def test_appended_loads_reconcile(spark, data, tmp_path):
    tables, sink = {"departments": data.warehouse["departments"]}, sinks.folder_sink(str(tmp_path))
    for _ in range(2):
        (row,) = sinks.load_in_fk_order(tables, sink, truncate=False).collect()
        assert (row["source_rows"], row["target_rows"], row["status"]) == (8, 8, "matched")
    assert spark.read.parquet(str(tmp_path / "departments")).count() == 16


def test_bills_without_admission_stay(spark):
    bill = cleaning.clean_billing(fixtures.raw_billing(spark, SF))
    adm = cleaning.clean_admissions(fixtures.raw_admissions(spark, SF)).where("ward_type <> 'ICU'")
    linked = cleaning.link_billing_by_encounter(bill, adm)
    assert linked.count() == bill.count()
    lost = linked.where("admission_id IS NULL")
    assert lost.count() > 0 and lost.where("patient_id IS NOT NULL OR linkage_method IS NOT NULL").count() == 0


def test_features_of_an_empty_extract(spark):
    from wardlens.operators.features import engineer_features

    adm = cleaning.clean_admissions(fixtures.raw_admissions(spark, SF)).limit(0)
    bill = cleaning.link_billing_by_encounter(cleaning.clean_billing(fixtures.raw_billing(spark, SF)), adm)
    assert engineer_features(adm, bill).count() == 0
