"""Fitted tree ensembles as flat node arrays: vectorised scores and exact per-feature contributions of whole batches.

MLlib's writer stores an ensemble as a table of nodes; the arrays are read from that table. They score rows outside of a DataFrame
(the recursive forecast) and explain rows inside one: a row's prediction is the root's value plus, for every split on its
path, the change of the node value, credited to the split's feature. These changes add up to the prediction exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.functions.files import remove
from wardlens.functions.scale import new_path
from wardlens.functions.shipping import ship_package

ROWS = 4096  # of a batch that are walked through all trees at once


@dataclass(frozen=True)
class FlatTrees:
    """Nodes of all trees one after the other. A leaf is its own child; rows at most ``threshold`` go left."""

    roots: np.ndarray
    left: np.ndarray
    right: np.ndarray
    slot: np.ndarray  # of the vector; 0 in leaves
    threshold: np.ndarray
    value: np.ndarray
    weight: np.ndarray  # of each tree
    depth: int
    slots: int

    @property
    def base(self) -> float:
        """Prediction before any split."""
        return float(np.dot(self.weight, self.value[self.roots]))

    def predict(self, rows: np.ndarray) -> np.ndarray:
        """Weighted sum of the leaf values."""
        out = np.zeros(len(rows))
        at_row = np.arange(len(rows))
        for root, weight in zip(self.roots, self.weight):
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                node = np.where(rows[at_row, self.slot[node]] <= self.threshold[node], self.left[node], self.right[node])
            out += weight * self.value[node]
        return out

    def contributions(self, rows: np.ndarray) -> np.ndarray:
        """One column per slot; a row's values and ``base`` add up to its prediction."""
        out = np.zeros((len(rows), self.slots))
        at_row = np.arange(len(rows))
        for root, weight in zip(self.roots, self.weight):
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                slot = self.slot[node]
                below = np.where(rows[at_row, slot] <= self.threshold[node], self.left[node], self.right[node])
                np.add.at(out, (at_row, slot), weight * (self.value[below] - self.value[node]))
                node = below
        return out


def _value(node, classes: bool) -> float:
    if not classes:
        return node["prediction"]
    stats = node["impurityStats"]
    return stats[1] / sum(stats) if sum(stats) else 0.0


def flatten(nodes: Iterable, weights: Sequence[float], slots: int, classes: bool, mean: bool) -> FlatTrees:
    """``nodes`` are rows of MLlib's table in order of tree and node; ``classes`` takes the positive class's share as value."""
    left, right, slot, threshold, value, roots = [], [], [], [], [], []
    tree = start = -1
    for row in nodes:
        node, here = row["nodeData"], len(value)
        if row["treeID"] != tree:
            tree, start = row["treeID"], here
            roots.append(here)
        split = node["split"]
        low, high, cut = node["leftChild"], node["rightChild"], float("inf")
        if low < 0:
            low = high = here - start
        elif split["numCategories"] < 0:
            cut = split["leftCategoriesOrThreshold"][0]
        else:  # a slot of zeros and ones: its listed category goes left
            if len(split["leftCategoriesOrThreshold"]) != 1 or split["numCategories"] != 2:
                raise ValueError("only two categories per slot are supported")
            cut = 0.5
            if split["leftCategoriesOrThreshold"][0] == 1.0:
                low, high = high, low
        for column, entry in zip(
            (left, right, slot, threshold, value), (start + low, start + high, max(split["featureIndex"], 0), cut, _value(node, classes))
        ):
            column.append(entry)
    left, right = np.array(left), np.array(right)
    depth, reached = 0, np.array(roots)
    while True:
        reached = np.unique(np.concatenate([left[reached], right[reached]]))
        inner = reached[left[reached] != reached]
        depth += 1
        if not len(inner):
            break
    scale = np.array(weights, float)
    return FlatTrees(
        np.array(roots), left, right, np.array(slot), np.array(threshold), np.array(value),
        scale / len(scale) if mean else scale, depth, slots,
    )


def is_ensemble(model: object) -> bool:
    return hasattr(model, "treeWeights")


def flat_trees(spark: SparkSession, model) -> FlatTrees:
    """The arrays of a fitted forest or boosted ensemble.

    A forest's value is its mean (of the positive class for a classifier), that of boosted trees the weighted sum, which
    for a classifier is half its log odds.
    """
    forest = type(model).__name__.startswith("RandomForest")
    folder = new_path(spark, "trees")
    model.write().save(folder)
    nodes = spark.read.parquet(f"{folder}/data").orderBy("treeID", "nodeData.id").collect()
    remove(spark, folder)
    classes = forest and hasattr(model, "numClasses")
    return flatten(nodes, model.treeWeights if not forest else [1.0] * len(model.treeWeights), model.numFeatures, classes, forest)


def with_contributions(scored: DataFrame, trees: FlatTrees, column: str = "tree_parts") -> DataFrame:
    """Rows with the contribution of every slot of their ``features`` vector, in batches through Arrow."""
    ship_package(scored.sparkSession)
    shared = scored.sparkSession.sparkContext.broadcast(trees)  # the size of one fitted model

    @F.pandas_udf("array<double>")
    def parts(vectors: Iterator[pd.Series]) -> Iterator[pd.Series]:
        flat = shared.value
        for series in vectors:
            rows = np.array(series.tolist(), float).reshape(len(series), flat.slots)
            found = [flat.contributions(rows[a : a + ROWS]) for a in range(0, len(rows), ROWS)]
            yield pd.Series([list(r) for part in found for r in part])

    return scored.withColumn(column, parts(vector_to_array("features")))


def last_stage(model: object):
    return model.stages[-1] if isinstance(model, PipelineModel) else model
