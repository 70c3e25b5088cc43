"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scale import materialize_small


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """(u, v): every node that is not the smallest of its component, with that smallest node.

    ``edges`` has columns u and v (long). Each step is written, so lineage stays short; minima combine map-side
    and the joins stream the edges, so a node with very many edges is split by adaptive execution.
    """
    current = materialize_small(edges.where("u <> v").select("u", "v").distinct(), "edges")
    while True:
        current = materialize_small(_small_star(_large_star(current)), "edges")
        facts = current.agg(F.count("*").alias("edges"), F.count_distinct("u").alias("nodes")).first()
        if facts["edges"] == facts["nodes"] and current.join(
            current.select(F.col("u").alias("v")), "v", "left_semi"
        ).isEmpty():
            return current
