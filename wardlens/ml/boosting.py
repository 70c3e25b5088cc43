"""Boosted trees fitted by counting whole blocks of rows: the same trees as MLlib's, at a fraction of its time per row and pass.

MLlib settles the thresholds and checks the rows; then every row is its bins, one byte per input, in blocks of columns that stay
in the cluster. A pass (one per level of a tree) adds count, sum and sum of squares of the residuals per open node,
input and bin inside each task; a task sends one small table, whatever its rows, and the driver picks the splits as MLlib does: same
formulas, same order of ties, same draws of a subsample. The result is MLlib's model. Rows, rounds and depths are the estimator's.
Several estimators on the same rows, or parts of them, grow their trees in the same passes.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.shipping import ship_package
from wardlens.ml.concurrent import run_all

BLOCK_ROWS = 65_536
KEPT = StorageLevel.MEMORY_AND_DISK_DESER  # the blocks as they are: every pass reads them, so they are not compressed
ROUNDS_KEPT = 20  # after so many rounds predictions are made anew from the bins: no longer chain of stored rounds is kept
EPSILON = 2.0**-52  # children of less impurity are leaves
NO_GAIN = -np.finfo(float).max  # of a split that is not allowed


@dataclass(frozen=True)
class Inputs:
    """How the vector's slots are binned: thresholds of a number, or None for a slot of categories."""

    bins: tuple[int, ...]
    thresholds: tuple[np.ndarray | None, ...]

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.bins)])

    @property
    def width(self) -> int:
        return max(self.bins)

    def binned(self, rows: np.ndarray) -> np.ndarray:
        """One row of bytes per slot; a value equal to a threshold is below it."""
        out = np.empty((len(self.bins), len(rows)), np.uint8)
        for k, cuts in enumerate(self.thresholds):
            out[k] = rows[:, k] if cuts is None else np.searchsorted(cuts, rows[:, k], side="left")
        return out


@dataclass
class Nodes:
    """A growing tree, parents before children. ``calc`` is weight, sum, sum of squares and rows of a node."""

    calc: list[tuple] = field(default_factory=list)
    impurity: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    split: list[tuple | None] = field(default_factory=list)  # slot, cut or left category, goes left by bin
    below: list[tuple[int, int] | None] = field(default_factory=list)

    def add(self, calc: tuple) -> int:
        self.calc.append(calc)
        self.impurity.append(_impurity(calc))
        self.gain.append(0.0)
        self.split.append(None)
        self.below.append(None)
        return len(self.calc) - 1

    def value(self, k: int) -> float:
        weight, total = self.calc[k][:2]
        return total / weight if weight else 0.0

    def merged(self, k: int = 0) -> bool:
        """Make leaves of nodes whose two leaves predict the same; whether ``k`` is a leaf now."""
        if self.below[k] is None:
            return True
        left, right = self.below[k]
        leaves = [self.merged(left), self.merged(right)]
        if all(leaves) and self.value(left) == self.value(right):
            self.below[k] = self.split[k] = None
            return True
        return False

    def walk(self, width: int) -> Walk:
        slot, to = np.zeros(len(self.calc), np.intp), np.repeat(np.arange(len(self.calc), dtype=np.intp)[:, None], width, 1)
        for k, below in enumerate(self.below):
            if below is not None:
                slot[k], left = self.split[k][0], self.split[k][2]
                to[k, : len(left)] = np.where(left, *below)
        return Walk(slot, to.ravel(), width, np.array([self.value(k) for k in range(len(self.calc))]))


@dataclass(frozen=True)
class Walk:
    """A tree as arrays: a row in a node goes on to ``to[node, bin of slot]``, in a leaf to itself."""

    slot: np.ndarray
    to: np.ndarray
    width: int
    value: np.ndarray

    def nodes(self, bins: np.ndarray, steps: int) -> np.ndarray:
        rows = bins.shape[1]
        flat, at = bins.ravel(), np.arange(rows)
        node = np.zeros(rows, np.intp)
        for _ in range(steps):
            node = self.to.take(node * self.width + flat.take(self.slot.take(node) * rows + at))
        return node


@dataclass(frozen=True)
class Rule:
    """What the tasks of a fit need to know beside the trees."""

    inputs: Inputs
    depth: int
    classes: bool
    rate: float  # of rows drawn per round
    seed: int


@dataclass
class Block:
    """Rows of one task: bins, label, prediction so far, and which rows the round draws (all if None)."""

    bins: np.ndarray
    label: np.ndarray
    score: np.ndarray | None = None
    drawn: np.ndarray | None = None

    def residual(self, classes: bool) -> np.ndarray:
        """The negative gradient of the loss, or the labels before the first tree."""
        if self.score is None:
            return self.label
        if classes:
            return 4.0 * self.label / (1.0 + np.exp(2.0 * self.label * self.score))
        return 2.0 * (self.label - self.score)


# --- draws of a subsample -----------------------------------------------------------------------------------------

_MASK = (1 << 64) - 1
LANES = 1024


def _murmur(data: bytes, seed: int) -> int:
    h, low = seed & 0xFFFFFFFF, 0xFFFFFFFF
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & low
        h ^= ((k << 15 | k >> 17) & low) * 0x1B873593 & low
        h = ((h << 13 | h >> 19) & low) * 5 + 0xE6546B64 & low
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & low
    h = (h ^ h >> 13) * 0xC2B2AE35 & low
    return h ^ h >> 16


def _state(seed: int) -> int:
    """The start of Spark's generator for ``seed``."""
    data = (seed & _MASK).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _next(state: np.ndarray) -> np.ndarray:
    state = state ^ (state << np.uint64(21))
    state ^= state >> np.uint64(35)
    return state ^ (state << np.uint64(4))


def _apply(columns: np.ndarray, states: np.ndarray) -> np.ndarray:
    """A linear map, given by what it makes of each bit, of every state."""
    out = np.zeros_like(states)
    for bit in range(64):
        out ^= np.where(states >> np.uint64(bit) & np.uint64(1), columns[bit], np.uint64(0))
    return out


def _power(steps: int) -> np.ndarray:
    square, out = _next(np.uint64(1) << np.arange(64, dtype=np.uint64)), np.uint64(1) << np.arange(64, dtype=np.uint64)
    while steps:
        if steps & 1:
            out = _apply(square, out)
        square, steps = _apply(square, square), steps >> 1
    return out


class Draws:
    """Numbers from 0 to 1 as Spark's generator gives them one after the other, made in lanes side by side."""

    def __init__(self, seed: int):
        self.state = np.array([_state(seed)], np.uint64)

    def take(self, count: int) -> np.ndarray:
        if not count:
            return np.zeros(0)
        each = -(-count // min(LANES, count))
        lanes, jump = self.state, _power(2 * each)
        while len(lanes) * each < count:
            lanes, jump = np.concatenate([lanes, _apply(jump, lanes)]), _apply(jump, jump)
        out = np.empty((len(lanes), each))
        high, low = np.uint64((1 << 26) - 1), np.uint64((1 << 27) - 1)
        for k in range(each):
            first = _next(lanes)
            lanes = _next(first)
            out[:, k] = (((first & high) << np.uint64(27)) + (lanes & low)) * 2.0**-53
        self.state = _apply(_power(2 * count), self.state)
        return out.ravel()[:count]


# --- tasks --------------------------------------------------------------------------------------------------------

def _blocks(batches: Iterable, rules: Sequence[Rule]) -> Iterator:
    """Arrow batches of vectors, labels and one mark per estimator as blocks, one row each: bins and labels per estimator."""
    import pyarrow as pa

    waiting, rows = [[] for _ in rules], 0

    def packed():
        columns = {}
        for k, parts in enumerate(waiting):
            columns[f"bins_{k}"] = [np.concatenate([b for b, _ in parts], axis=1).tobytes()]
            columns[f"label_{k}"] = [np.concatenate([y for _, y in parts]).tobytes()]
        return pa.RecordBatch.from_pydict(columns)

    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        label = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
        for k, rule in enumerate(rules):
            own = batch.column(2 + k).to_numpy(zero_copy_only=False).astype(bool)
            waiting[k].append((rule.inputs.binned(values[own]), label[own] * 2 - 1 if rule.classes else label[own]))
        rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield packed()
            waiting, rows = [[] for _ in rules], 0
    if rows:
        yield packed()


def _unpacked(row, rules: Sequence[Rule]) -> list[Block]:
    return [
        Block(np.frombuffer(row[2 * k], np.uint8).reshape(len(rule.inputs.bins), -1), np.frombuffer(row[2 * k + 1], float))
        for k, rule in enumerate(rules)
    ]


def _scored(
    part: int, blocks: Iterable[list[Block]], rules: Sequence[Rule], trees: Sequence[Sequence[tuple[Walk, float]]], number: int
) -> Iterator[list[Block]]:
    """The blocks before round ``number``: ``trees`` are added to their predictions and the round's rows are drawn."""
    draws = [Draws(rule.seed + number + part + 1) if rule.rate < 1.0 else None for rule in rules]

    def moved(block: Block, rule: Rule, added: Sequence[tuple[Walk, float]], numbers: Draws | None) -> Block:
        score = block.score
        for tree, weight in added:
            more = tree.value.take(tree.nodes(block.bins, rule.depth)) * weight
            score = more if score is None else score + more
        drawn = None if numbers is None else numbers.take(len(block.label)) < rule.rate
        return Block(block.bins, block.label, score, drawn)

    for several in blocks:
        yield [moved(*one) for one in zip(several, rules, trees, draws)]


@dataclass(frozen=True)
class Level:
    """What a pass counts of an estimator: its tree so far, the steps to its open nodes and their positions."""

    tree: Walk | None
    steps: int
    position: np.ndarray


def _counted(blocks: Iterable[list[Block]], rules: Sequence[Rule], levels: Sequence[Level | None]) -> Iterator[list]:
    """Rows, sum and sum of squares of the residuals per open node, slot and bin: one table per task and estimator."""
    out = [None if v is None else np.zeros((3, v.position.max() + 1, r.inputs.starts[-1])) for r, v in zip(rules, levels)]
    for several in blocks:
        for block, rule, level, table in zip(several, rules, levels, out):
            if level is not None:
                _count(block, rule, level, table)
    yield out


def _count(block: Block, rule: Rule, level: Level, out: np.ndarray) -> None:
    count, starts = out.shape[1], rule.inputs.starts
    residual = block.residual(rule.classes)
    if level.tree is None:
        node = np.zeros(len(residual), np.intp)
    else:
        node = level.position.take(level.tree.nodes(block.bins, level.steps))
    if block.drawn is not None:
        node = np.where(block.drawn, node, -1)
    node[node < 0] = count  # closed or not drawn
    squares = residual * residual
    for k, bins in enumerate(rule.inputs.bins):
        if bins < 2:
            continue
        at = node * bins + block.bins[k]
        size, span = (count + 1) * bins, slice(starts[k], starts[k + 1])
        for table, weights in zip(out, (None, residual, squares)):
            table[:, span] += np.bincount(at, weights, size)[: count * bins].reshape(count, bins)


# --- splits -------------------------------------------------------------------------------------------------------

def _impurity(calc: Sequence[float]) -> float:
    weight, total, squares = calc[:3]
    return 0.0 if weight == 0 else (squares - total * total / weight) / weight


def _impurities(calc: np.ndarray) -> np.ndarray:
    weight, total, squares = calc
    some = np.where(weight == 0, 1.0, weight)
    return np.where(weight == 0, 0.0, (squares - total * total / some) / some)


def _best_split(table: np.ndarray, inputs: Inputs, calc: tuple | None, least_gain: float, least_rows: float) -> tuple:
    """Gain, split and the sums of both sides; of equal gains the first. Also the node's own sums, which a root learns here."""
    starts, best = inputs.starts, None
    for k, bins in enumerate(inputs.bins):
        if bins < 2:
            continue
        here = table[:, starts[k] : starts[k + 1]]
        order = np.arange(bins)
        if inputs.thresholds[k] is None:  # categories by their mean, empty ones last
            means = np.divide(here[1], here[0], out=np.full(bins, np.finfo(float).max), where=here[0] != 0)
            order = np.argsort(means, kind="stable")
        sums = np.cumsum(here[:, order], axis=1)
        left = sums[:, :-1]
        right = sums[:, -1:] - left
        if calc is None:
            calc = tuple(left[:, 0] + right[:, 0])
        impurity = _impurity(calc)
        whole = left[0] + right[0]
        with np.errstate(invalid="ignore"):
            gain = impurity - left[0] / whole * _impurities(left) - right[0] / whole * _impurities(right)
        allowed = (left[0] >= least_rows) & (right[0] >= least_rows) & ~(gain < least_gain)
        gain = np.where(allowed, gain, NO_GAIN)
        at = int(np.argmax(gain))
        if best is None or gain[at] > best[0]:
            goes_left = np.zeros(bins, bool)
            goes_left[order[: at + 1]] = True
            cut = inputs.thresholds[k][at] if inputs.thresholds[k] is not None else order[: at + 1].tolist()
            best = (float(gain[at]), (k, cut, goes_left), tuple(left[:, at]), tuple(right[:, at]))
    return (*best, calc)


class Growth:
    """One estimator's tree of a round: what its next pass counts, and the level that comes of the counts."""

    def __init__(self, rule: Rule, least_gain: float, least_rows: float):
        self.rule, self.least = rule, (least_gain, least_rows)
        self.nodes, self.open, self.depth = Nodes(), [None], 0

    def level(self) -> Level | None:
        if not self.open or self.depth == self.rule.depth:
            return None
        position = np.full(max(len(self.nodes.calc), 1), -1, np.intp)
        position[[k or 0 for k in self.open]] = np.arange(len(self.open))
        return Level(self.nodes.walk(self.rule.inputs.width) if self.depth else None, self.depth, position)

    def grow(self, total: np.ndarray) -> None:
        nodes, following = self.nodes, []
        self.depth += 1
        for number, k in enumerate(self.open):
            known = None if k is None else nodes.calc[k]
            gain, split, left, right, calc = _best_split(total[:, number], self.rule.inputs, known, *self.least)
            k = nodes.add(calc) if k is None else k
            nodes.gain[k] = gain
            if gain <= 0:
                if gain == NO_GAIN:
                    nodes.impurity[k] = -1.0  # as MLlib marks a leaf without an allowed split
                continue
            nodes.split[k], nodes.below[k] = split, (nodes.add(left), nodes.add(right))
            if self.depth < self.rule.depth:
                following += [b for b in nodes.below[k] if abs(nodes.impurity[b]) >= EPSILON]
        self.open = following


def _grown(rounds: RDD, growths: Sequence[Growth | None]) -> None:
    """One tree of every estimator, level by level: a pass over all rows for each."""
    rules = [None if g is None else g.rule for g in growths]
    while True:
        levels = [None if g is None else g.level() for g in growths]
        if not any(levels):
            break
        found = rounds.mapPartitions(partial(_counted, rules=rules, levels=levels)).collect()
        for k, growth in enumerate(growths):
            if levels[k] is not None:
                growth.grow(reduce(np.add, [tables[k] for tables in found]))
    for growth in growths:
        if growth is not None:
            growth.nodes.merged()


# --- MLlib on both ends -------------------------------------------------------------------------------------------

def _inputs(estimator, data: DataFrame) -> Inputs:
    """The bins that MLlib gives the rows, after its checks of labels and vectors."""
    jvm = data.sparkSession._jvm

    def of(package, name: str):
        return getattr(getattr(package, f"{name}$"), "MODULE$")

    estimator._transfer_params_to_java()
    java = estimator._java_obj
    tree = jvm.org.apache.spark.ml.tree.impl
    kinds = of(jvm.org.apache.spark.ml.util, "MetadataUtils").getCategoricalFeatures(
        data._jdf.schema().apply(estimator.getFeaturesCol())
    )
    algo = jvm.org.apache.spark.mllib.tree.configuration.Algo.Regression()
    strategy = java.getOldBoostingStrategy(kinds, algo).treeStrategy().copy()
    strategy.setAlgo(algo)
    strategy.setImpurity(jvm.org.apache.spark.mllib.tree.impurity.Variance.instance())
    classes = getattr(jvm.scala, "Some")(2) if isinstance(estimator, GBTClassifier) else jvm.scala.Option.empty()
    instances = of(jvm.org.apache.spark.ml.util, "DatasetUtils").extractInstances(java, data._jdf, classes)
    metadata = of(tree, "DecisionTreeMetadata").buildMetadata(instances, strategy, 1, estimator.getFeatureSubsetStrategy())
    splits = of(tree, "RandomForest").findSplits(instances, metadata, estimator.getSeed())
    slots = range(metadata.numFeatures())
    thresholds = tuple(
        np.array([s.threshold() for s in splits[k]], float) if metadata.isContinuous(k) else None for k in slots
    )
    return Inputs(tuple(metadata.numBins()), thresholds)


def _java_tree(jvm, gateway, nodes: Nodes, slots: int):
    """MLlib's tree of the nodes."""
    ml, calculator = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    buffer = jvm.java.nio.ByteBuffer.wrap(np.array([c[:3] for c in nodes.calc], ">f8").tobytes()).asDoubleBuffer()
    sums = gateway.new_array(gateway.jvm.double, 3 * len(nodes.calc))
    buffer.get(sums)

    def node(k: int):
        stats = calculator(jvm.java.util.Arrays.copyOfRange(sums, 3 * k, 3 * k + 3), int(nodes.calc[k][0]))
        if nodes.below[k] is None:
            return ml.LeafNode(nodes.value(k), float(nodes.impurity[k]), stats)
        slot, cut, goes_left = nodes.split[k]
        if isinstance(cut, list):
            left = gateway.new_array(gateway.jvm.double, len(cut))
            for i, category in enumerate(cut):
                left[i] = float(category)
            split = ml.CategoricalSplit(slot, left, len(goes_left))
        else:
            split = ml.ContinuousSplit(slot, float(cut))
        a, b = (node(c) for c in nodes.below[k])
        return ml.InternalNode(nodes.value(k), float(nodes.impurity[k]), float(nodes.gain[k]), a, b, split, stats)

    uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("dtr")
    return jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(uid, node(0), slots)


def _model(estimator, data: DataFrame, trees: Sequence[Nodes], weights: Sequence[float], slots: int):
    jvm, gateway = data.sparkSession._jvm, data.sparkSession.sparkContext._gateway
    made = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    scale = gateway.new_array(gateway.jvm.double, len(trees))
    for k, (tree, weight) in enumerate(zip(trees, weights)):
        made[k], scale[k] = _java_tree(jvm, gateway, tree, slots), float(weight)
    java = estimator._java_obj
    if isinstance(estimator, GBTClassifier):
        fitted = jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), made, scale, slots, 2)
    else:
        fitted = jvm.org.apache.spark.ml.regression.GBTRegressionModel(java.uid(), made, scale, slots)
    fitted = java.copyValues(fitted, jvm.org.apache.spark.ml.param.ParamMap.empty()).setParent(java)
    model = (GBTClassificationModel if isinstance(estimator, GBTClassifier) else GBTRegressionModel)(fitted)
    model._resetUid(estimator.uid)
    return estimator._copyValues(model)


def is_counted(estimator) -> bool:
    """Whether ``fit_boosted`` covers the estimator's settings: all inputs at every split, no weights, squared or logistic loss."""
    if not isinstance(estimator, (GBTClassifier, GBTRegressor)):
        return False
    plain = estimator.getFeatureSubsetStrategy() == "all" and estimator.getMinWeightFractionPerNode() == 0.0
    loss = isinstance(estimator, GBTClassifier) or estimator.getLossType() == "squared"
    rest = estimator.isSet("weightCol") or estimator.isSet("validationIndicatorCol")
    return plain and loss and not rest and 0 < estimator.getMaxDepth() <= 8 and estimator.getMaxBins() <= 256


def fit_boosted(work: Mapping[Hashable, tuple[object, Column | None]], data: DataFrame) -> dict:
    """The models of the estimators, each on the rows of ``data`` where its condition holds (None: all of them), by name.

    ``data`` should be stored: it is read three times per estimator, and once more into bins.
    """
    spark, estimators = data.sparkSession, [e for e, _ in work.values()]
    if len({(e.getFeaturesCol(), e.getLabelCol()) for e in estimators}) > 1:
        raise ValueError("the estimators must read the same features and labels")
    parts = [data if where is None else data.where(where) for _, where in work.values()]
    inputs = list(run_all(spark, {k: partial(_inputs, e, part) for k, (e, part) in enumerate(zip(estimators, parts))}).values())
    if min(i.width for i in inputs) < 2:
        return {n: e.fit(part) for n, e, part in zip(work, estimators, parts)}  # nothing to split by
    ship_package(spark)
    rules = [
        Rule(i, e.getMaxDepth(), isinstance(e, GBTClassifier), e.getSubsamplingRate(), e.getSeed()) for e, i in zip(estimators, inputs)
    ]
    first = estimators[0]
    marks = [F.lit(True) if where is None else F.coalesce(where, F.lit(False)) for _, where in work.values()]
    vectors = data.select(
        vector_to_array(first.getFeaturesCol()).alias("v"), F.col(first.getLabelCol()).cast("double").alias("y"),
        *[m.alias(f"own_{k}") for k, m in enumerate(marks)],
    )
    schema = ", ".join(f"bins_{k} binary, label_{k} binary" for k in range(len(rules)))
    packed = vectors.mapInArrow(partial(_blocks, rules=rules), schema)
    base = packed.rdd.map(partial(_unpacked, rules=rules)).persist(KEPT)
    trees: list[list[Nodes]] = [[] for _ in rules]
    walks: list[list[tuple[Walk, float]]] = [[] for _ in rules]
    stored: list[RDD] = []
    try:
        for number in range(max(e.getMaxIter() for e in estimators)):
            anew = number % ROUNDS_KEPT == 0
            added = [w if anew else w[number - 1 :] for w in walks]
            before = base if anew else stored[-1]
            stored.append(before.mapPartitionsWithIndex(partial(_scored, rules=rules, trees=added, number=number)).persist(KEPT))
            growths = [
                Growth(r, e.getMinInfoGain(), e.getMinInstancesPerNode()) if number < e.getMaxIter() else None
                for r, e in zip(rules, estimators)
            ]
            _grown(stored[-1], growths)
            for k, growth in enumerate(growths):
                if growth is not None:
                    trees[k].append(growth.nodes)
                    walks[k].append((growth.nodes.walk(inputs[k].width), estimators[k].getStepSize() if number else 1.0))
            if len(stored) > 1:
                stored.pop(0).unpersist()
    finally:
        for kept in (base, *stored):
            kept.unpersist()
    return {
        n: _model(e, data, trees[k], [w for _, w in walks[k]], len(inputs[k].bins)) for k, (n, e) in enumerate(zip(work, estimators))
    }
