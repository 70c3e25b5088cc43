"""Writers for the warehouse and load reconciliation (R1.3, R2.1-R2.3)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.functions.columns import mean
from wardlens.functions.scale import beside
from wardlens.operators.marts import metric_rows
from wardlens.sources.schemas import LOAD_ORDER

# Fact tables stored by admission year, so date filters skip whole folders.
YEARLY = {"admissions": "admit_date", "appointments": "admit_date", "model_features": "admit_date"}


def write_table(df: DataFrame, directory: str, name: str, mode: str = "overwrite") -> None:
    writer = df
    if name in YEARLY:
        # One task per year and hash slice: large years are still written by many tasks.
        year = F.year(YEARLY[name])
        writer = df.withColumn("admit_year", year).hint("rebalance", "admit_year")
        writer.write.mode(mode).partitionBy("admit_year").parquet(f"{directory}/{name}")
    else:
        writer.write.mode(mode).parquet(f"{directory}/{name}")


def write_warehouse(wh: Mapping[str, DataFrame], directory: str) -> None:
    for name, df in wh.items():
        write_table(df, directory, name)


def read_warehouse(spark: SparkSession, directory: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{directory}/{n}") for n in names}


def jdbc_sink(url: str, **options: str) -> tuple[Callable[[DataFrame, str, str], None], Callable[[SparkSession, str], DataFrame]]:
    """Write and read functions for a relational store reachable over JDBC."""

    def write(df: DataFrame, name: str, mode: str) -> None:
        df.write.format("jdbc").options(url=url, dbtable=name, **{"truncate": "true", **options}).mode(mode).save()

    def read(spark: SparkSession, name: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()

    return write, read


def folder_sink(directory: str) -> tuple[Callable[[DataFrame, str, str], None], Callable[[SparkSession, str], DataFrame]]:
    return (
        lambda df, name, mode: write_table(df, directory, name, mode),
        lambda spark, name: spark.read.parquet(f"{directory}/{name}"),
    )


def load_in_fk_order(
    wh: Mapping[str, DataFrame],
    sink: tuple[Callable[[DataFrame, str, str], None], Callable[[SparkSession, str], DataFrame]],
    truncate: bool = True,
) -> DataFrame:
    """Write parents before children and reconcile the rows added to each table with the source."""
    write, read = sink

    def stored(name: str) -> int:
        try:
            return read(wh[name].sparkSession, name).count()
        except AnalysisException:  # not there yet
            return 0

    names = [n for n in LOAD_ORDER if n in wh] + [n for n in wh if n not in LOAD_ORDER]
    rows = []
    for position, name in enumerate(names, start=1):
        before = 0 if truncate else stored(name)
        write(wh[name], name, "overwrite" if truncate else "append")
        source, target = wh[name].count(), stored(name) - before
        rows.append((position, name, source, target, "matched" if source == target else "mismatch"))
    spark = wh[names[0]].sparkSession
    return spark.createDataFrame(rows, "load_order int, table_name string, source_rows bigint, target_rows bigint, status string")


def table_counts(wh: Mapping[str, DataFrame], expected: tuple[str, ...] = LOAD_ORDER) -> DataFrame:
    """Row count per expected table; a missing table is listed without a count."""
    present = [wh[n].agg(F.lit(n).alias("table_name"), F.count("*").alias("rows")) for n in expected if n in wh]
    absent = [n for n in expected if n not in wh]
    out = reduce(DataFrame.unionByName, present)
    if absent:
        out = out.unionByName(out.sparkSession.createDataFrame([(n, None) for n in absent], "table_name string, rows bigint"))
    return out


def query_evidence(wh: Mapping[str, DataFrame]) -> DataFrame:
    """Eight headline metrics, missing values as zero."""
    care = wh["admissions"].agg(
        F.count("*").alias("a"), mean("readmitted_30d").alias("r"), mean("los_days").alias("l")
    )
    one = beside(
        care,
        wh["patients"].agg(F.count("*").alias("p")),
        wh["billing"].agg(F.sum("paid_amount").alias("m")),
        wh["claims"].agg(mean("claim_approved").alias("c")),
        wh["command_center_kpis"].agg(F.first("hospital_efficiency_score").alias("s")),
        wh["operational_forecast_summary"].agg(F.first("emergency_patients").alias("e")),
    )
    names = {
        "a": "Admissions",
        "p": "Patients",
        "r": "Readmission rate",
        "l": "Average LOS",
        "m": "Paid revenue",
        "c": "Claim approval ratio",
        "s": "Hospital efficiency score",
        "e": "Next-week emergency patients",
    }
    return metric_rows(one, names).withColumn("value", F.coalesce("value", F.lit(0.0)))
