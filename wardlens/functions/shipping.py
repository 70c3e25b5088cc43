"""The package's own code for the Python workers, so executors need no installed copy."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Spark distribute a zip of the package to all executors, once per application. The zip is code, not data."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    base = Path(tempfile.mkdtemp()) / package.name
    archive = shutil.make_archive(str(base), "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
