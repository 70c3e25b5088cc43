"""Row-level ingest rules on arriving bills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardlens.functions.files import exists
from wardlens.operators.cleaning import derive_claim_fields

ARRIVED = "arrived_at"
REPEATS_WITHIN = "7 days"  # of arrival, in which the stream itself remembers keys


def ingest_bills(arriving: DataFrame, directory: str, checkpoint: str) -> StreamingQuery:
    """Derive gap and approval of every arriving bill and append it to the stored bills.

    The rule looks at one row at a time, so the stream keeps no state; the checkpoint makes a restart resume
    where the last commit ended.
    """
    return (
        derive_claim_fields(arriving)
        .writeStream.format("parquet")
        .option("path", directory)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def arriving_bills(spark: SparkSession, landing: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """Bills from files that land in a folder, with the time their file arrived."""
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    return files.withColumn(ARRIVED, F.col("_metadata.file_modification_time"))


def stored_bills(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.parquet(directory).drop("batch")


def ingest_keyed_bills(
    arriving: DataFrame, directory: str, checkpoint: str, key: Sequence[str] = ("billing_id",), within: str = REPEATS_WITHIN
) -> StreamingQuery:
    """``ingest_bills`` for a table with a primary key: a bill that arrives again is not stored again.

    A repeat within ``within`` of arrival is dropped by the stream's state, which the watermark keeps bounded whatever the stream's
    age. A later one is left out by an anti join of its batch with the keys already stored. A batch that is
    repeated after a failure replaces its own folder and compares with the batches before it only, so it stores the same
    rows again. Bills without a key are refused.
    """
    present = arriving.where(" AND ".join(f"{k} IS NOT NULL" for k in key))
    fresh = present.withWatermark(ARRIVED, within).dropDuplicatesWithinWatermark(list(key))

    def store(batch: DataFrame, number: int) -> None:
        spark, new = batch.sparkSession, derive_claim_fields(batch)
        if exists(spark, directory):
            known = spark.read.schema(new.schema.add("batch", "long")).parquet(directory)
            new = new.join(known.where(F.col("batch") < number).select(*key), list(key), "left_anti")
        new.write.mode("overwrite").parquet(f"{directory}/batch={number}")

    return (
        fresh.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
