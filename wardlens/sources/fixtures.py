"""Raw admissions and billing derived from the order tables (mapping in FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _cycle(column: str, factor: int, modulo: int) -> Column:
    return (F.col(column) * factor) % modulo


def raw_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "o_orderkey"
    orders = _table(spark, sf_dir, "orders")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    admit = F.col("o_orderdate").cast("date")
    stay = _cycle(key, 7, 13).cast("int")
    ward = F.col(key) % 10
    visit = F.col(key) * 29 + F.col("o_custkey")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        _text("ADM", key).alias("admission_id"),
        _text("PAT", "o_custkey").alias("patient_id"),
        _text("HOS", "c_nationkey").alias("hospital_id"),
        admit.alias("admit_date"),
        F.date_add(admit, stay).alias("discharge_date"),
        stay.alias("los_days"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Emergency")
        .when(F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED"), "OPD")
        .otherwise("Elective")
        .alias("admit_type"),
        F.when(ward == 0, "ICU").when(ward == 1, "HDU").when(ward == 2, "NICU").otherwise("General").alias("ward_type"),
        F.when(F.col("o_orderstatus") == "F", "Home")
        .when(F.col("o_orderstatus") == "O", "Transfer")
        .otherwise("Other")
        .alias("discharge_type"),
        _cycle(key, 3, 5).cast("int").alias("num_procedures"),
        _cycle(key, 11, 7).cast("int").alias("charlson_index"),
        (4.5 + _cycle(key, 13, 60).cast("double") / 10.0).alias("hba1c"),
        (0.5 + _cycle(key, 17, 20).cast("double") / 10.0).alias("creatinine"),
        (8.0 + _cycle(key, 19, 90).cast("double") / 10.0).alias("haemoglobin"),
        (95 + _cycle(key, 23, 80)).cast("double").alias("systolic_bp"),
        F.when(visit % 8 == 0, 1).otherwise(0).alias("readmitted_30d"),
        F.when(visit % 24 == 0, 1).otherwise(0).alias("readmitted_7d"),
    )


def raw_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    # Lines repeat per order and line number: combine them before joining the order attributes. They move once, by order.
    # Smallest labels are compared as flags, which a hash aggregate keeps; smallest strings would be sorted for.
    smallest = lambda c, v: F.max(F.col(c) == v) & ~F.max(F.col(c) < v)
    combined = lines.repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_shipdate").cast("date").alias("claim_billing_date"),
        smallest("l_returnflag", "R").alias("denied"),
        (smallest("l_returnflag", "N") & smallest("l_linestatus", "O")).alias("pending"),
        F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).alias("gross"),
    )
    denied, pending = F.col("denied"), F.col("pending")
    line = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    method = F.col("l_linenumber") % 3
    return (
        combined.join(orders, combined.l_orderkey == orders.o_orderkey)
        .join(customers, orders.o_custkey == customers.c_custkey)
        .select(
            F.concat(F.lit("BIL"), line).alias("billing_id"),
            F.concat(F.lit("CLM"), line).alias("claim_id"),
            _text("SRC", "o_custkey").alias("patient_id"),
            _text("ENC", "l_orderkey").alias("encounter_id"),
            "claim_billing_date",
            F.col("c_mktsegment").alias("insurance_provider"),
            F.when(method == 0, "Cash").when(method == 1, "Card").otherwise("Transfer").alias("payment_method"),
            F.when(denied, "Denied").when(pending, "Pending").otherwise("Paid").alias("claim_status"),
            F.col("gross").cast("decimal(14,2)").alias("billed_amount"),
            F.when(denied | pending, F.lit(0).cast("decimal(14,2)"))
            .otherwise((F.col("gross") * F.lit("0.92").cast("decimal(2,2)")).cast("decimal(14,2)"))
            .alias("paid_amount"),
        )
    )


def _key_of(column: str, pattern: str) -> Column:
    return F.regexp_extract(F.col(column), pattern, 1).cast("bigint")


def dirty_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text variant with unparsable numbers, missing wards, outliers, bad dates and repeated rows."""
    raw = raw_admissions(spark, sf_dir).withColumn("k", _key_of("admission_id", r"ADM(\d+)"))
    every = lambda n: F.col("k") % n == 0
    text = raw.select(
        "k", "admission_id", "patient_id", "hospital_id",
        F.col("admit_date").cast("string").alias("admit_date"),
        F.when(every(211), F.date_sub("admit_date", 3)).otherwise(F.col("discharge_date")).cast("string").alias("discharge_date"),
        F.col("los_days").cast("string").alias("los_days"),
        "admit_type",
        F.when(~every(40), F.col("ward_type")).alias("ward_type"),
        "discharge_type",
        F.col("num_procedures").cast("string").alias("num_procedures"),
        F.col("charlson_index").cast("string").alias("charlson_index"),
        F.when(every(50), F.lit("n/a")).otherwise(F.col("hba1c").cast("string")).alias("hba1c"),
        F.when(every(97), F.col("creatinine") * 50).otherwise(F.col("creatinine")).cast("string").alias("creatinine"),
        F.col("haemoglobin").cast("string").alias("haemoglobin"),
        F.col("systolic_bp").cast("string").alias("systolic_bp"),
        F.col("readmitted_30d").cast("string").alias("readmitted_30d"),
        F.col("readmitted_7d").cast("string").alias("readmitted_7d"),
    )
    copies = F.when(every(100), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return text.withColumn("copy", F.explode(copies)).drop("k", "copy")


def dirty_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (
        raw_billing(spark, sf_dir)
        .withColumn("k", _key_of("billing_id", r"BIL(\d+)-"))
        .withColumn("line", _key_of("billing_id", r"-(\d+)$"))
    )
    return raw.select(
        "billing_id", "claim_id", "patient_id", "encounter_id",
        F.when(F.col("k") % 33 != 0, F.date_format("claim_billing_date", "dd/MM/yyyy")).alias("claim_billing_date"),
        F.when(F.col("k") % 29 != 0, F.col("insurance_provider")).alias("insurance_provider"),
        "payment_method",
        F.when((F.col("claim_status") == "Denied") & (F.col("line") == 7), "Rejected")
        .otherwise(F.col("claim_status"))
        .alias("claim_status"),
        F.col("billed_amount").cast("string").alias("billed_amount"),
        F.col("paid_amount").cast("string").alias("paid_amount"),
    )
