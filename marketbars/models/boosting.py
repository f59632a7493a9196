"""Boosted regression trees over categories so many that MLlib's split search stalls.

MLlib looks up sorted categories by position in a linked list, so the search of a node
costs the square of the categories, in one task. Here Spark and NumPy grow the trees of
``GBTRegressor`` with its default loss, all inputs and all rows: MLlib finds the bins and
keeps the model, tasks sum labels by node, input and bin, and a search costs a sort.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.workspace import new_folder, remove, shuffles_removed

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 1 << 18  # rows that are packed together
PURE = np.finfo(float).eps


@dataclass
class Node:
    """Count, sum and sum of squares of the labels in a node, and its split if it has one."""

    sums: np.ndarray
    feature: int | None = None
    left: np.ndarray | int | None = None  # flags of the bins that go left, or the last of them
    gain: float = 0.0


@dataclass
class Tree:
    """Nodes by number: the children of ``n`` are ``2 n`` and ``2 n + 1``, the root is 1."""

    nodes: dict[int, Node] = field(default_factory=dict)

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The number of the last node that each row comes to."""
        place = np.ones(bins.shape[1], dtype=np.int32)
        for number, node in sorted(self.nodes.items()):
            if node.feature is None:
                continue
            rows = np.flatnonzero(place == number)
            values = bins[node.feature][rows]
            left = node.left[values] if isinstance(node.left, np.ndarray) else values <= node.left
            place[rows] = 2 * number + ~left
        return place

    def predictions(self, bins: np.ndarray) -> np.ndarray:
        values = np.zeros(max(self.nodes) + 1)
        for number, node in self.nodes.items():
            values[number] = node.sums[1] / node.sums[0]
        return values[self.places(bins)]


def impurity(sums: np.ndarray) -> np.ndarray:
    """Variance from count, sum and sum of squares; 0 of nothing."""
    count, total, squares = sums
    safe = np.where(count == 0, 1, count)
    return np.where(count == 0, 0.0, (squares - total * total / safe) / safe)


def best_split(sums: np.ndarray, categorical: bool) -> tuple[float, int, np.ndarray, np.ndarray]:
    """Gain of the best split of one input, its place, the order of bins, and the sums left of it.

    Categories are tried in the order of their mean labels, those without rows at the end.
    """
    bins = sums.shape[1]
    order = np.arange(bins)
    if categorical:
        with np.errstate(divide="ignore", invalid="ignore"):
            means = np.where(sums[0] == 0, np.finfo(float).max, sums[1] / sums[0])
        order = np.argsort(means, kind="stable")
    upto = np.cumsum(sums[:, order], axis=1)
    left, total = upto[:, :-1], upto[:, -1:]
    right = total - left
    parts = left[0] / total[0] * impurity(left) + right[0] / total[0] * impurity(right)
    gain = impurity(total) - parts
    gain[(left[0] < 1) | (right[0] < 1) | (gain < 0)] = -np.inf
    at = int(np.argmax(gain))
    return float(gain[at]), at, order, left[:, at]


def _packed(inputs: Sequence[str], label: str, limits: list[np.ndarray | None]) -> Callable:
    """Rows of numbers to rows of many binned rows each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            bins = np.empty((len(inputs), table.num_rows), dtype=np.int32)
            for k, (name, limit) in enumerate(zip(inputs, limits, strict=True)):
                values = table[name].to_numpy()
                bins[k] = values if limit is None else np.searchsorted(limit, values)
            labels = table[label].to_numpy().astype(np.float64)
            return pa.RecordBatch.from_pydict({"bins": [bins.tobytes()], "labels": [labels.tobytes()]})

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK:
                yield packed()
                held.clear()
        if held:
            yield packed()

    return pack


def _summed(grown: list[Tree], step: float, tree: Tree, open_nodes: list[int], sizes: list[int]) -> Callable:
    """Packed rows to sums of what is left to explain, by open node, input and bin."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {(n, k): np.zeros((3, size)) for n in open_nodes for k, size in enumerate(sizes)}
        for batch in batches:
            for row in batch.to_pylist():
                labels = np.frombuffer(row["labels"])
                bins = np.frombuffer(row["bins"], dtype=np.int32).reshape(len(sizes), -1)
                if grown:
                    said = grown[0].predictions(bins)
                    for before in grown[1:]:
                        said = said + step * before.predictions(bins)
                    labels = 2 * (labels - said)
                place = tree.places(bins)
                for number in open_nodes:
                    rows = np.flatnonzero(place == number)
                    own = labels[rows]
                    for k, size in enumerate(sizes):
                        values, into = bins[k][rows], sums[number, k]
                        into[0] += np.bincount(values, minlength=size)
                        into[1] += np.bincount(values, own, size)
                        into[2] += np.bincount(values, own * own, size)
        for (number, k), into in sums.items():
            if into[0].any():
                yield pa.RecordBatch.from_pydict(
                    {"node": [number], "feature": [k], "sums": [into.tobytes()]}
                )

    return add


def _searched(categories: dict[int, int]) -> Callable[[pa.Table], pa.Table]:
    """Sums of one node and input from all tasks to the best split on that input."""

    def search(table: pa.Table) -> pa.Table:
        number, feature = table["node"][0].as_py(), table["feature"][0].as_py()
        sums = sum(np.frombuffer(x.as_buffer()).reshape(3, -1) for x in table["sums"])
        found: dict[str, Any] = {"gain": float("-inf"), "at": 0, "left": None, "left_sums": [0.0] * 3}
        if sums.shape[1] > 1:
            gain, at, order, left = best_split(sums, feature in categories)
            found = {"gain": gain, "at": at, "left": None, "left_sums": left.tolist()}
            if feature in categories and gain > 0:
                found["left"] = order[: at + 1].astype(np.int32).tobytes()
        row = {"node": number, "feature": feature, "all_sums": sums.sum(axis=1).tolist()} | found
        return pa.Table.from_pylist([row], schema=_FOUND)

    return search


_FOUND = pa.schema(
    [("node", pa.int64()), ("feature", pa.int64()), ("all_sums", pa.list_(pa.float64())),
     ("gain", pa.float64()), ("at", pa.int64()), ("left", pa.binary()), ("left_sums", pa.list_(pa.float64()))]
)
_FOUND_SQL = (
    "node long, feature long, all_sums array<double>, gain double, at long, left binary, "
    "left_sums array<double>"
)


def _grow(
    packed: DataFrame, grown: list[Tree], step: float, depth: int, sizes: list[int], categories: dict[int, int]
) -> Tree:
    """The next tree, a level at a time."""
    tree, open_nodes = Tree(), [1]
    for level in range(depth):
        sums = packed.mapInArrow(
            _summed(grown, step, tree, open_nodes, sizes), "node long, feature long, sums binary"
        )
        with shuffles_removed(packed.sparkSession):
            found = sums.groupBy("node", "feature").applyInArrow(_searched(categories), _FOUND_SQL)
            rows = found.collect()  # one for each open node and input
        next_nodes = []
        for number in open_nodes:
            own = sorted((r for r in rows if r.node == number), key=lambda r: r.feature)
            node = tree.nodes.setdefault(number, Node(np.array(own[0].all_sums)))
            best = max(own, key=lambda r: r.gain)  # the first of equals
            if not best.gain > 0:
                continue
            node.feature, node.gain, node.left = best.feature, best.gain, best.at
            if best.feature in categories:
                node.left = np.zeros(sizes[best.feature], dtype=bool)
                node.left[np.frombuffer(best.left, dtype=np.int32)] = True
            left = np.array(best.left_sums)
            for child, child_sums in ((2 * number, left), (2 * number + 1, node.sums - left)):
                tree.nodes[child] = Node(child_sums)
                if level + 1 < depth and abs(impurity(child_sums)) >= PURE:
                    next_nodes.append(child)
        open_nodes = next_nodes
        if not open_nodes:
            break
    return tree


def _thresholds(expected: float, most: int) -> Callable[[pa.Table], pa.Table]:
    """Counts of an input's values to the thresholds of its bins, as MLlib chooses them."""

    def choose(table: pa.Table) -> pa.Table:
        feature = table["feature"][0].as_py()
        values, counts = table["value"].to_numpy(), table["n"].to_numpy().astype(float)
        found = values != 0.0
        values, counts = values[found], counts[found]
        seen, limits = counts.sum(), np.empty(0)
        if len(values):
            # The rows that are expected beyond those seen are taken for zeros.
            if expected - seen > PURE * seen * 100:
                values, counts = np.append(values, 0.0), np.append(counts, expected - seen)
            order = np.argsort(values)
            values, counts = values[order], counts[order]
            middles = (values[:-1] + values[1:]) / 2.0
            limits = middles if len(middles) <= most else middles[_stops(counts, expected / (most + 1))]
        row = {"feature": feature, "limits": limits.tobytes()}
        return pa.Table.from_pylist([row], schema=pa.schema([("feature", pa.int64()), ("limits", pa.binary())]))

    return choose


def _stops(counts: np.ndarray, stride: float) -> list[int]:
    """Places after which the count so far is nearer to the next target than it is one later."""
    stops, so_far, target = [], counts[0], stride
    for k, count in enumerate(counts[1:].tolist()):
        before, so_far = so_far, so_far + count
        if abs(before - target) < abs(so_far - target):
            stops.append(k)
            target += stride
    return stops


def _limits(
    rows: DataFrame, inputs: Sequence[str], numeric: list[int], max_bins: int, seed: int
) -> dict[int, np.ndarray]:
    """Thresholds of the numeric inputs, from the rows that MLlib would draw for them."""
    spark, count = rows.sparkSession, rows.count()
    bins = min(max_bins, count)
    wanted = max((bins * bins + 2**31) % 2**32 - 2**31, 10_000)  # an int there, which may overflow
    share = 1.0
    if wanted < count:
        share = wanted / count
        drawn = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        sampled = rows._jdf.rdd().sample(False, share, drawn)
        rows = DataFrame(spark._jsparkSession.createDataFrame(sampled, rows._jdf.schema()), spark)
    each = [
        F.struct(F.lit(k).alias("feature"), F.col(inputs[k]).cast("double").alias("value"))
        for k in numeric
    ]
    values = rows.select(F.inline(F.array(*each)))
    counts = values.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    with shuffles_removed(spark):
        found = (
            counts.groupBy("feature")
            .applyInArrow(_thresholds(share * count, bins - 1), "feature long, limits binary")
            .collect()  # a row for each input
        )
    return {r.feature: np.frombuffer(r.limits) for r in found}


def _doubles(spark: SparkSession, values: np.ndarray) -> Any:
    """A Java array, filled in one call."""
    array = spark.sparkContext._gateway.new_array(spark._jvm.double, len(values))
    data = bytearray(np.asarray(values, dtype=">f8").tobytes())
    spark._jvm.java.nio.ByteBuffer.wrap(data).asDoubleBuffer().get(array)
    return array


def _java_node(spark: SparkSession, tree: Tree, number: int, sizes: list[int], limits: list) -> Any:
    jvm, node = spark._jvm, tree.nodes[number]
    ml = jvm.org.apache.spark.ml.tree
    stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(
        _doubles(spark, node.sums), int(node.sums[0])
    )
    mean, spread = float(node.sums[1] / node.sums[0]), float(impurity(node.sums))
    if node.feature is None:
        return ml.LeafNode(mean, spread, stats)
    children = [_java_node(spark, tree, 2 * number + k, sizes, limits) for k in (0, 1)]
    if isinstance(node.left, np.ndarray):
        left = _doubles(spark, np.flatnonzero(node.left))
        split = ml.CategoricalSplit(node.feature, left, sizes[node.feature])
    else:
        split = ml.ContinuousSplit(node.feature, float(limits[node.feature][node.left]))
    return ml.InternalNode(mean, spread, float(node.gain), *children, split, stats)


def fit(estimator: GBTRegressor, assembled: DataFrame, inputs: Sequence[str]) -> GBTRegressionModel:
    """The model that ``estimator.fit(assembled)`` gives; ``inputs`` are what ``features`` holds."""
    spark, label = assembled.sparkSession, estimator.getLabelCol()
    jvm = spark._jvm
    estimator._transfer_params_to_java()
    java = estimator._java_obj
    field_ = assembled._jdf.schema().apply(estimator.getFeaturesCol())
    java_categories = jvm.org.apache.spark.ml.util.MetadataUtils.getCategoricalFeatures(field_)
    categories = {
        k: java_categories.apply(k) for k in range(len(inputs)) if java_categories.contains(k)
    }
    rows = assembled.select(*inputs, label)
    numeric = [k for k in range(len(inputs)) if k not in categories]
    found = _limits(rows, inputs, numeric, estimator.getMaxBins(), estimator.getSeed())
    limits = [None if k in categories else found.get(k, np.empty(0)) for k in range(len(inputs))]
    sizes = [categories[k] if x is None else len(x) + 1 for k, x in enumerate(limits)]

    staged = new_folder(spark, "bins")
    try:
        rows.mapInArrow(_packed(inputs, label, limits), "bins binary, labels binary").write.option(
            "compression", "zstd"
        ).parquet(staged)
        packed = spark.read.schema("bins binary, labels binary").parquet(staged)
        grown: list[Tree] = []
        for _ in range(estimator.getMaxIter()):
            grown.append(
                _grow(packed, grown, estimator.getStepSize(), estimator.getMaxDepth(), sizes, categories)
            )
    finally:
        remove(spark, staged)

    ml = jvm.org.apache.spark.ml.regression
    trees = spark.sparkContext._gateway.new_array(ml.DecisionTreeRegressionModel, len(grown))
    for k, tree in enumerate(grown):
        root = _java_node(spark, tree, 1, sizes, limits)
        trees[k] = ml.DecisionTreeRegressionModel(root, len(inputs))
    weights = np.array([1.0] + [estimator.getStepSize()] * (len(grown) - 1))
    made = ml.GBTRegressionModel(estimator.uid, trees, _doubles(spark, weights), len(inputs))
    java.copyValues(made, jvm.org.apache.spark.ml.param.ParamMap())
    return estimator._copyValues(GBTRegressionModel(made.setParent(java)))
