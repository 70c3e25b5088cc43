"""Ranks, totals and quantiles against pandas, with hot values and several chunks."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardlens.functions import scale


@pytest.fixture(scope="module")
def numbers(spark):
    """A third of the values are one number."""
    rng = np.random.default_rng(7)
    values = np.where(rng.random(6000) < 1 / 3, 50, rng.integers(0, 1000, 6000))
    return pd.DataFrame({"id": range(6000), "v": values.astype("int64")})


@pytest.mark.parametrize("limit", [scale.HISTOGRAM_LIMIT, 10])
def test_quantiles_equal_pandas(spark, numbers, monkeypatch, limit):
    monkeypatch.setattr(scale, "HISTOGRAM_LIMIT", limit)
    asked = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.9, 1.0]
    found = scale.exact_quantiles(spark.createDataFrame(numbers), {"v": asked})["v"]
    assert found == pytest.approx(list(numbers["v"].quantile(asked)))


def test_quantiles_skip_nulls_and_handle_empty(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None)], "a double, b double")
    assert scale.exact_quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": [2.5], "b": [None]}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40))
def test_wide_path_for_any_list(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    ranks = sorted({0, len(values) // 2, len(values) - 1})
    assert scale._values_at(df, "v", ranks) == {r: float(sorted(values)[r]) for r in ranks}


def test_row_index_is_dense_and_ordered(spark, numbers):
    shuffled = spark.createDataFrame(numbers.sample(frac=1, random_state=1)).repartition(5)
    indexed = scale.with_row_index(shuffled, ["v", "id"], "test_index").toPandas().sort_values("row_index")
    expected = numbers.sort_values(["v", "id"])
    assert list(indexed["row_index"]) == list(range(6000))
    assert list(indexed["id"]) == list(expected["id"])


def test_chunks_split_the_rows(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).withColumn("k", F.col("id") * 7919 % 20_011)
        chunked = scale.with_order_chunks(df, ["k"], "test_chunks")
        assert chunked.select("chunk").distinct().count() > 4
        totals = scale.running_totals(df, ["k"], {"n": F.lit(1)}, "test_totals")
        assert totals.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, 20_000, 20_000)
        at = scale.order_statistics(df, ["k"], [0, 9_999, 19_999], "test_stats")
        ordered = sorted(r["k"] for r in df.collect())
        assert {r: row["k"] for r, row in at.items()} == {r: ordered[r] for r in (0, 9_999, 19_999)}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_outer_join_from_the_many_side(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, x string")
    many = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (9, 90)], "k int, y int")
    found = {(r["k"], r["x"], r["y"]) for r in scale.join_many_to_one_keep_all(one, many, "k").collect()}
    assert found == {(1, "a", 10), (1, "a", 11), (2, "b", 20), (3, "c", None)}


def test_intermediates_live_under_the_application(spark):
    stored = scale.materialize(spark.range(3), "kept")
    assert f"/wardlens/{spark.sparkContext.applicationId}/kept-" in stored.inputFiles()[0]


def test_intermediates_can_be_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scale, "shared_dir", lambda session: str(tmp_path))
    monkeypatch.setattr(scale, "_bucketed_tables", {})
    scale.materialize(spark.range(3), "gone")
    scale.materialize_bucketed(spark.range(30), "gone_too", "id", 4)
    assert len(list(tmp_path.rglob("*.parquet"))) >= 5
    table = scale._bucketed_tables[spark.sparkContext.applicationId][0]
    assert scale.remove_intermediates(spark) and not list(tmp_path.rglob("*.parquet"))
    assert not spark.catalog.tableExists(table)


def test_shared_folder_setting_is_used(spark):
    assert scale.new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
