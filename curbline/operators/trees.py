"""Forests and boosted trees of more rows than the ML library's own fits take.

The library holds every training row as objects, with a count for each tree of a forest:
some 600 bytes a row by its fields, which spill to disk. Here a row is a byte a feature (the number of
its value range) and its label, in blocks of rows that stay with the tasks. A pass over the
blocks sums labels by node, feature and value range; only these sums travel, and one
pass makes a level of a tree, or of several trees of a forest. The method is the
library's: splits of largest variance reduction at quantiles of the features, Poisson counts
and a third of the features a node for a forest, squared loss for boosting. The outcome is the
library's model.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.session import shared_dir
from curbline.sources import storage

BLOCK_ROWS = 65_536
#: Trees of a forest that grow in the same passes: a task holds their sums.
TREES_TOGETHER = 20
#: Boosted trees after which the rows' remainders are worked out anew from all trees, so that
#: no chain of stored remainders grows longer.
TREES_CHAINED = 25
#: Sums are kept for all nodes of a level; deeper trees are left to the library.
MAX_DEPTH, MAX_BINS = 12, 256
#: Share of a node's squared sum below which a gain is rounding.
ROUNDING = 1e-12
# Parameters that are followed, and those that change nothing in a model.
FOLLOWED = {"numTrees", "maxIter", "maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "seed", "stepSize"}
NEUTRAL = {"featuresCol", "labelCol", "predictionCol", "leafCol", "maxMemoryInMB", "cacheNodeIds", "checkpointInterval"}
# Poisson(1) counts, each as often as its share of 65,536 equally likely numbers.
_POISSON = np.repeat(np.arange(8, dtype=np.uint8), [24109, 24109, 12055, 4018, 1005, 201, 33, 6])
NODE_SCHEMA = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>,"
    " rawCount long, gain double, leftChild int, rightChild int,"
    " split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


@dataclass(frozen=True)
class Settings:
    trees: int
    depth: int
    bins: int
    tried: int  # features a node chooses from
    min_rows: int
    min_gain: float
    seed: int


class Tree:
    """Nodes of all levels in one row: the children of node i are 2i + 1 and 2i + 2. A node
    without a split sends its rows to the left, so sums of the last level cover all rows."""

    def __init__(self, depth: int):
        inner = (1 << depth) - 1
        self.feature, self.bin = np.full(inner, -1), np.full(inner, 255, np.uint8)
        self.gain, self.stats = np.zeros(inner), np.zeros((2 * inner + 1, 3))

    def walk(self, codes: np.ndarray, rows: np.ndarray, levels: int) -> np.ndarray:
        """Number, within its level, of the node each row reaches after so many levels."""
        node, flat = np.zeros(len(rows), np.int64), codes.ravel()
        start = np.maximum(self.feature, 0) * codes.shape[1]
        for _ in range(levels):
            node = 2 * node + 1 + (flat.take(start.take(node) + rows) > self.bin.take(node))
        return node - ((1 << levels) - 1)

    def place(self, level: int, found: tuple) -> None:
        """Take over the splits found for a level, where the parent has a split too."""
        feature, cut, gain, total, left = found
        first = (1 << level) - 1
        at = np.arange(first, 2 * first + 1)
        if level:
            feature = np.where(self.feature[(at - 1) // 2] >= 0, feature, -1)
        split = feature >= 0
        self.feature[at], self.bin[at] = feature, np.where(split, cut, 255)
        self.gain[at] = np.where(split, gain, 0.0)
        if total.shape[1] == 3:  # the last level
            left = np.where(split[:, None], left, total)
            self.stats[at], self.stats[2 * at + 1], self.stats[2 * at + 2] = total, left, total - left
            for i in range(first - 1, -1, -1):
                self.stats[i] = self.stats[2 * i + 1] + self.stats[2 * i + 2]

    def leaf_values(self) -> np.ndarray:
        """Prediction at each place below the last level."""
        count, total = self.stats[:, 0], self.stats[:, 1]
        value = np.divide(total, count, out=np.zeros(len(count)), where=count > 0)
        for i, f in enumerate(self.feature):
            if f < 0:  # its rows are all to the left
                value[2 * i + 1] = value[2 * i + 2] = value[i]
        return value[len(self.feature) :]

    def nodes(self, cuts: list[np.ndarray]) -> list[tuple]:
        """Nodes as the library stores them: numbered from the root, left before right."""
        out: list[tuple] = []

        def add(i: int) -> int:
            n, total, squares = (float(v) for v in self.stats[i])
            mean = total / n
            head = (mean, max(squares / n - mean * mean, 0.0), [n, total, squares], round(n))
            nth = len(out)
            out.append(())
            if i >= len(self.feature) or self.feature[i] < 0:
                out[nth] = (nth, *head, -1.0, -1, -1, (-1, [], -1))
            else:
                f = int(self.feature[i])
                below = (f, [float(cuts[f][self.bin[i]])], -1)
                out[nth] = (nth, *head, float(self.gain[i]), add(2 * i + 1), add(2 * i + 2), below)
            return nth

        add(0)
        return out


def growable(regressor) -> bool:
    """Whether the parameters of a forest or boosted regressor are among those followed here."""
    if not isinstance(regressor, (RandomForestRegressor, GBTRegressor)):
        return False
    given = {p.name for p in regressor.params if regressor.isSet(p)}
    return (
        given <= FOLLOWED | NEUTRAL and 1 <= regressor.getMaxDepth() <= MAX_DEPTH and 2 <= regressor.getMaxBins() <= MAX_BINS
    )


def settings(regressor, features: int) -> Settings:
    forest = isinstance(regressor, RandomForestRegressor)
    trees = regressor.getNumTrees() if forest else regressor.getMaxIter()
    return Settings(
        trees,
        regressor.getMaxDepth(),
        regressor.getMaxBins(),
        -(-features // 3) if forest and trees > 1 else features,
        regressor.getMinInstancesPerNode(),
        regressor.getMinInfoGain(),
        regressor.getSeed(),
    )


def value_ranges(rows: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Upper ends of the value ranges of each feature: midpoints between its values, if these
    are no more than ``bins``, or else quantiles of all rows."""
    shares = [i / bins for i in range(1, bins)]
    about = rows.agg(
        *[F.approx_count_distinct(f).alias(f"n_{f}") for f in features],
        *[F.percentile_approx(f, shares, 10_000).alias(f"q_{f}") for f in features],
    ).first()
    few = [f for f in features if about[f"n_{f}"] <= 2 * bins]
    found = rows.agg(*[F.sort_array(F.collect_set(f)).alias(f) for f in few]).first() if few else {}
    cuts = []
    for f in features:
        if f in few and len(found[f]) <= bins:
            values = np.asarray(found[f], float)
            cuts.append((values[:-1] + values[1:]) / 2)
        else:
            cuts.append(np.unique(np.asarray(about[f"q_{f}"] or [], float)))
    return cuts


def _encoded(batches: Iterator[pa.RecordBatch], features: list[str], label: str, cuts) -> Iterator[pa.RecordBatch]:
    """Blocks of rows, each with a number of its own: a byte a feature, and the labels."""
    held, rows, number = [], 0, TaskContext.get().partitionId() << 32

    def block() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        codes = [np.searchsorted(c, table[f].to_numpy().astype(float)) for f, c in zip(features, cuts, strict=True)]
        labels = table[label].to_numpy().astype(float)
        if not np.isfinite(labels).all():
            raise ValueError(f"{label} must be a finite number in all training rows")
        packed = np.array(codes, np.uint8).tobytes()
        return pa.RecordBatch.from_pydict({"number": [number], "codes": [packed], "labels": [labels.tobytes()]})

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield block()
            held, rows, number = [], 0, number + 1
    if held:
        yield block()


def blocks(rows: DataFrame, features: list[str], label: str, cuts, tasks: int) -> RDD:
    """(number, codes, labels) of blocks of rows, dealt over the tasks."""
    encode = partial(_encoded, features=features, label=label, cuts=cuts)
    plain = rows.select(*features, label).mapInArrow(encode, "number long, codes binary, labels binary")

    def unpacked(row) -> tuple:
        labels = np.frombuffer(row["labels"])
        return row["number"], np.frombuffer(row["codes"], np.uint8).reshape(len(features), len(labels)), labels

    return plain.repartition(tasks).rdd.map(unpacked)


def _add_sums(sums: np.ndarray, node: np.ndarray, codes: list[np.ndarray], weights: list) -> None:
    """Add rows to sums by node, feature and value range, one for each kind of weight."""
    nodes, _, bins, _ = sums.shape
    for k, code in enumerate(codes):
        cell = node * bins + code
        for j, weight in enumerate(weights):
            sums[:, k, :, j] += np.bincount(cell, weight, nodes * bins).reshape(nodes, bins)


def _powers(labels: np.ndarray, counts: np.ndarray | None, last: bool) -> list:
    """Weights of the sums: count, label and, on the last level, squared label."""
    once = labels if counts is None else labels * counts
    return [counts, once, once * labels] if last else [counts, once]


def _plain_sums(part, tree: Tree, level: int, s: Settings, features: int):
    """Sums of a level over the blocks of a task."""
    last = level == s.depth - 1
    sums = np.zeros((1 << level, features, s.bins, 2 + last))
    for _, codes, labels in part:
        node = tree.walk(codes, np.arange(len(labels)), level)
        _add_sums(sums, node, list(codes), _powers(labels, None, last))
    yield sums


def _bag(s: Settings, tree: int, number: int, rows: int) -> np.ndarray:
    """How often a tree takes each row of a block, the same in every pass."""
    drawn = np.random.SFC64(np.random.SeedSequence([s.seed & 0xFFFFFFFF, tree, number]))
    return _POISSON.take(np.frombuffer(np.random.Generator(drawn).bytes(2 * rows), np.uint16))


def _bagged_sums(part, grown: dict[int, Tree], tried: dict[int, np.ndarray], level: int, s: Settings):
    """The same for some trees of a forest, each over its own draw of the rows."""
    last = level == s.depth - 1
    sums = {t: np.zeros((1 << level, s.tried, s.bins, 2 + last)) for t in grown}
    for number, codes, labels in part:
        flat = codes.ravel()
        for t, tree in grown.items():
            counts = _bag(s, t, number, len(labels))
            rows = np.flatnonzero(counts)
            node = tree.walk(codes, rows, level)
            chosen = [flat.take((tried[t][:, k] * len(labels)).take(node) + rows) for k in range(s.tried)]
            _add_sums(sums[t], node, chosen, _powers(labels[rows], counts[rows].astype(float), last))
    yield from sums.items()


def best_splits(sums: np.ndarray, tried: np.ndarray, s: Settings) -> tuple:
    """Feature (-1: none), range, gain, sums of the node and of its left side, for each node."""
    upto = sums.cumsum(axis=2)
    total, left = upto[:, 0, -1, :], upto[:, :, :-1, :]
    n, whole = total[:, None, None, 0], total[:, None, None, 1]
    n_left, sum_left = left[..., 0], left[..., 1]
    n_right, sum_right = n - n_left, whole - sum_left
    with np.errstate(divide="ignore", invalid="ignore"):
        before = whole**2 / n
        gain = (sum_left**2 / n_left + sum_right**2 / n_right - before) / n
        most = max(s.min_rows, 1)
        fits = (n_left >= most) & (n_right >= most) & (gain >= s.min_gain) & (gain * n > ROUNDING * before)
    gain = np.where(fits, gain, 0.0).reshape(len(sums), -1)
    best, node = gain.argmax(axis=1), np.arange(len(sums))
    k, cut = np.divmod(best, s.bins - 1)
    won = gain[node, best]
    return np.where(won > 0, tried[node, k], -1), cut, won, total, left[node, k, cut]


def forest(rows: RDD, features: int, s: Settings) -> list[Tree]:
    trees: list[Tree] = []
    for first in range(0, s.trees, TREES_TOGETHER):
        grown = {t: Tree(s.depth) for t in range(first, min(first + TREES_TOGETHER, s.trees))}
        for level in range(s.depth):
            tried = {}
            for t in grown:
                draw = np.random.default_rng([s.seed & 0xFFFFFFFF, t, level])
                order = draw.random((1 << level, features)).argsort(axis=1)
                tried[t] = np.sort(order[:, : s.tried], axis=1)
            found = (
                rows.mapPartitions(partial(_bagged_sums, grown=grown, tried=tried, level=level, s=s))
                .reduceByKey(np.add, len(grown))
                .map(lambda kv, tried=tried: (kv[0], best_splits(kv[1], tried[kv[0]], s)))
            )
            for t, splits in found.collect():
                grown[t].place(level, splits)
        trees += grown.values()
    return trees


def _remainder(block: tuple, steps: list[tuple]) -> tuple:
    """What trees leave of the labels: each step has a tree, the values of its leaves, and the
    factors of the label and of the value."""
    number, codes, labels = block
    rows = np.arange(len(labels))
    for tree, values, of_label, of_value in steps:
        labels = of_label * labels - of_value * values.take(tree.walk(codes, rows, len(values).bit_length() - 1))
    return number, codes, labels


def boosted(rows: RDD, features: int, s: Settings, step: float) -> list[Tree]:
    """Each tree is fitted to the gradient of the squared loss, twice what the trees before
    leave; the first tree counts whole, as the library has it."""
    trees, steps, state, every = [], [], rows, np.broadcast_to(np.arange(features), (1 << s.depth, features))
    for m in range(s.trees):
        tree, before = Tree(s.depth), state
        if m:
            again = m % TREES_CHAINED == 0
            state = (rows if again else before).map(partial(_remainder, steps=steps[:] if again else steps[-1:]))
            state.persist(StorageLevel.MEMORY_AND_DISK_DESER)
        for level in range(s.depth):
            sums = state.mapPartitions(partial(_plain_sums, tree=tree, level=level, s=s, features=features))
            tree.place(level, best_splits(sum(sums.collect()), every, s))
        if before not in (rows, state):
            before.unpersist()
        steps.append((tree, tree.leaf_values(), 1.0 if m else 2.0, 2 * step if m else 2.0))
        trees.append(tree)
    if state is not rows:
        state.unpersist()
    return trees


def _as_model(spark: SparkSession, regressor, trees: list[Tree], weights: list[float], features: int, cuts):
    """The library's own model, by way of the files it saves a model in."""
    kind = RandomForestRegressionModel if isinstance(regressor, RandomForestRegressor) else GBTRegressionModel
    path = shared_dir(spark, "trees")
    regressor.save(f"{path}/regressor")
    about = json.loads(spark.read.text(f"{path}/regressor/metadata").first()[0])
    made = {"timestamp": int(time.time() * 1000), "numFeatures": features}
    about |= made | {"class": f"org.apache.spark.ml.regression.{kind.__name__}", "numTrees": len(trees)}
    shared = ("featuresCol", "labelCol", "predictionCol", "maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "seed")
    own = {k: {p: v for p, v in about[k].items() if p in shared} for k in ("paramMap", "defaultParamMap")}
    one = {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "sparkVersion": about["sparkVersion"]}
    each = [
        (i, json.dumps(one | made | own | {"uid": f"{about['uid']}_{i}"}), float(w)) for i, w in enumerate(weights)
    ]
    nodes = [(i, node) for i, tree in enumerate(trees) for node in tree.nodes(cuts)]
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").write.parquet(f"{path}/model/treesMetadata")
    spark.createDataFrame(nodes, NODE_SCHEMA).write.parquet(f"{path}/model/data")
    model = kind.load(f"{path}/model")
    storage.drop_folder(spark, path)
    return model


def fitted(regressor, rows: DataFrame, features: list[str], label: str, tasks: int | None = None):
    """``regressor`` fitted to all rows, over at least as many tasks as there are cores."""
    spark, s = rows.sparkSession, settings(regressor, len(features))
    cuts = value_ranges(rows, features, s.bins)
    tasks = tasks or spark.sparkContext.defaultParallelism
    held = blocks(rows, features, label, cuts, tasks).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        if isinstance(regressor, RandomForestRegressor):
            trees = forest(held, len(features), s)
            weights = [1.0] * len(trees)
        else:
            step = regressor.getStepSize()
            trees = boosted(held, len(features), s, step)
            weights = [1.0, *[step] * (len(trees) - 1)]
    finally:
        held.unpersist()
    return _as_model(spark, regressor, trees, weights, len(features), cuts)
