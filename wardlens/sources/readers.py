"""Readers for the raw extracts and for stored tables (R1.1, R1.2)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardlens.sources.schemas import ADMISSION_COLUMNS, BILLING_COLUMNS, landing_schema

# File names of the two extracts.
RAW_FILES = {"admissions": "admissions.csv", "billing": "claims_and_billing.csv"}


def _extract(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """Columns are matched by header name; all of them land as text.

    The part files of one extract must agree in their header; one whose columns are in another order raises an error
    instead of being read by position.
    """
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return reader.schema(landing_schema(tuple(header))).csv(path).select(*columns)


def read_raw(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return (
        _extract(spark, f"{path}/{RAW_FILES['admissions']}", ADMISSION_COLUMNS),
        _extract(spark, f"{path}/{RAW_FILES['billing']}", BILLING_COLUMNS),
    )


def _load(spark: SparkSession, path: str, kind: str, schema: T.StructType | None) -> DataFrame | None:
    reader = spark.read.option("header", True).option("enforceSchema", False) if kind == "csv" else spark.read
    try:
        return (reader.schema(schema) if schema and kind == "csv" else reader).format(kind).load(path)
    except AnalysisException as error:
        if error.getCondition() and error.getCondition().startswith("PATH_NOT_FOUND"):
            return None
        raise


def read_table(spark: SparkSession, directory: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """First of ``name.csv.gz``, ``name.csv`` and the Parquet folder ``name`` that exists.

    CSV columns have the types of ``schema``, and are text without one: types are never guessed, so "007" stays.
    """
    candidates = ((f"{directory}/{name}.csv.gz", "csv"), (f"{directory}/{name}.csv", "csv"), (f"{directory}/{name}", "parquet"))
    for path, kind in candidates:
        found = _load(spark, path, kind, schema)
        if found is not None:
            return found
    raise FileNotFoundError("missing table: expected " + " or ".join(path for path, _ in candidates))
