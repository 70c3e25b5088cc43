"""The package's own code and batches of whole texts for the Python workers."""

from __future__ import annotations

from pyspark.sql import SparkSession

from wardlens.functions import shipping

BATCH_ROWS = 2000  # rows of whole texts that go to a Python worker at once
BATCH_BYTES = "8m"  # and most bytes of them; packed rows are large, and the executor holds a batch outside of its heap


def ship_package(spark: SparkSession) -> None:
    """Let Spark distribute the package, and bound the Arrow batches, as the defaults are meant for narrow rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    shipping.ship_package(spark)
