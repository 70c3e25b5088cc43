from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
SF = "/root/testdata/sf0.001"


def small_models():
    """Contracts on models need fitted ones, not good ones; registered queries train full sizes."""
    from wardlens.ml.models import ModelSizes
    from wardlens.plans.dataset import HospitalData

    HospitalData.model_sizes = ModelSizes(
        forest_trees=6, forest_depth=4, regression_trees=6, regression_depth=4, boosting_rounds=4, stacking_trees=4,
        stacking_depth=3, stacking_rounds=3, stacking_folds=2,
    )


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    small_models()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data(spark):
    from wardlens.plans.dataset import open_fixture

    return open_fixture(spark, SF)
