"""Random forests for two classes, all trees in the same passes, as models of MLlib.

Features are cut into bins once; rows are written as blocks of bins, label, weight and a hash of the key.  A
level of all trees is grown by passes over the blocks: a task walks its rows down each tree to the nodes that
are open and counts them per (node, tried feature, bin, class); the counts are added per tree, and tasks of
their own choose each node's best split, so the driver gets one line per node.  Trees whose counts would exceed
``SUM_BYTES`` a task take further passes: memory is bounded by that and by a chunk of rows, whatever the table.

As in MLlib, a row counts in a tree as often as a Poisson number says, here drawn from its key and the tree (rows
of equal keys are drawn together); a node tries a random subset of the features; splits go by Gini impurity over
weighted rows; a child has at least ``min_rows`` drawn rows; leaves of one parent that predict the same class become one.
Defined cases: rows without label or weight count as 0 and 1; NaN goes right; equal gains take the first
tried feature and cut; no rows are an error.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarescan.operators.boosting import COLUMNS, ROWS_PER_TASK, _Columns, feature_cuts
from rarescan.operators.perceptron import sliced
from rarescan.sources.shared import discard, materialize, new_path

MAX_BINS = 32
SUM_BYTES = 32_000_000  # of the counts of a task
CHUNK_ROWS = 16_384  # walked at once
KEPT_BYTES = 256_000_000  # of blocks kept in memory; more are read again
SMALL = 2.220446049250313e-16

# Poisson numbers of mean 1 by 20 random bits
POISSON = np.searchsorted(
    np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), (np.arange(1 << 20) + 0.5) / (1 << 20)
).astype(np.uint8)

BLOCKS = "n int, bins binary, label binary, weight binary, hash binary"


@dataclass(frozen=True)
class Forest:
    trees: int = 100
    max_depth: int = 10
    min_rows: int = 1
    max_features: str = "sqrt"  # or "log2", "all", a share or a number
    seed: int = 42

    def tried(self, features: int) -> int:
        """How many features a node tries."""
        named = {
            "all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": math.ceil(math.log2(max(features, 2))),
        }
        if self.max_features in named:
            return max(1, named[self.max_features])
        if str(self.max_features).isdigit():
            return max(1, min(int(self.max_features), features))
        return max(1, math.ceil(float(self.max_features) * features))

    def subset(self, features: int, tree: int, node: int) -> np.ndarray:
        pick = np.random.default_rng([self.seed, tree, node])
        return np.sort(pick.permutation(features)[: self.tried(features)])

    def drawn(self, hashes: np.ndarray, tree: int) -> np.ndarray:
        """How often each row counts in a tree."""
        if self.trees == 1:
            return np.ones(len(hashes), np.uint8)
        x = hashes ^ np.uint64((self.seed * 0x9E3779B97F4A7C15 + tree * 0xD1342543DE82EF95) % (1 << 64))
        for _ in range(2):
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = x ^ (x >> np.uint64(32))
        return POISSON.take(x >> np.uint64(44), mode="clip")


# ---- passes -----------------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, len(cuts) + 17):
        x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
        bins = np.empty(x.shape, np.uint8)  # row by row: a walk stays in a cache line
        for slot, cut in enumerate(cuts):
            bins[:, slot] = np.searchsorted(cut, np.where(np.isnan(x[:, slot]), np.inf, x[:, slot]))
        whole = lambda name, kind: batch[name].to_numpy(zero_copy_only=False).astype(kind)
        columns = [bins, whole("label", np.uint8), whole("weight", np.float64), whole("hash", np.int64)]
        arrays = [pa.array([batch.num_rows], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)]
        yield pa.record_batch(arrays, ["n", "bins", "label", "weight", "hash"])


def _chunks(rows: Iterator) -> Iterator[list[np.ndarray]]:
    """Bins, labels, weights and hashes of blocks, joined up to ``CHUNK_ROWS``."""
    kinds = {"bins": np.uint8, "label": np.uint8, "weight": np.float64, "hash": np.uint64}
    waiting: list[list[np.ndarray]] = []
    for row in rows:
        waiting.append([np.frombuffer(row[name], kind) for name, kind in kinds.items()])
        if sum(len(w[1]) for w in waiting) >= CHUNK_ROWS:
            yield [np.concatenate(c) for c in zip(*waiting)]
            waiting = []
    if waiting:
        yield [np.concatenate(c) for c in zip(*waiting)]


@dataclass(frozen=True)
class Walk:
    """A tree as far as grown: a leaf is its own child; ``slot`` numbers the open nodes of a pass."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    slot: np.ndarray
    subset: np.ndarray  # slot -> features tried


@dataclass(frozen=True)
class Level:
    """What a task counts: drawn rows per (open node, tried feature, bin, class), and their weights if
    these are not the same all over a class."""

    how: Forest
    walks: dict[int, Walk]
    features: int
    bins: int
    level: int
    weights: bool

    def __call__(self, rows: Iterator) -> Iterator[tuple[int, np.ndarray]]:
        tried = self.how.tried(self.features)
        sizes = {t: len(w.subset) * tried * self.bins * 2 for t, w in self.walks.items()}
        sums = {t: np.zeros((1 + self.weights, size)) for t, size in sizes.items()}
        # where the counts of (open node, tried feature) begin
        starts = {t: np.arange(size // self.bins // 2).reshape(-1, tried) * (2 * self.bins) for t, size in sizes.items()}
        for bins, label, weight, hashes in _chunks(rows):
            classed = (bins.reshape(-1, self.features) * np.uint8(2) + label[:, None]).ravel()
            for tree, walk in self.walks.items():
                times = self.how.drawn(hashes, tree)
                own = np.flatnonzero(times)
                base, node = own * self.features, np.zeros(len(own), np.intp)
                for _ in range(self.level):
                    found = bins.take(base + walk.feature.take(node, mode="clip"), mode="clip")
                    node = walk.child.take(node, mode="clip") + (found > walk.cut.take(node, mode="clip"))
                slot = walk.slot[node]
                open_ = slot >= 0
                if not open_.all():
                    own, base, slot = own[open_], base[open_], slot[open_]
                place = walk.subset.take(slot, axis=0, mode="clip")
                place += base[:, None]
                place = starts[tree].take(slot, axis=0, mode="clip") + classed.take(place, mode="clip")
                place, times = place.ravel(), times[own].astype(np.float64)
                sums[tree][0] += np.bincount(place, np.repeat(times, tried), sizes[tree])
                if self.weights:
                    sums[tree][1] += np.bincount(place, np.repeat(times * weight[own], tried), sizes[tree])
        yield from sums.items()


@dataclass(frozen=True)
class Choice:
    """The best split per open node from its counts: gain, place in the subset, bin, then rows and
    weights per class of the node and of its left child."""

    how: Forest
    tried: int
    bins: int
    class_weights: tuple[float, float] | None

    def __call__(self, sums: np.ndarray) -> np.ndarray:
        counts = sums.reshape(len(sums), -1, self.tried, self.bins, 2)
        rows = counts[0]
        weights = counts[1] if self.class_weights is None else rows * np.array(self.class_weights)
        whole_rows, whole = rows[:, 0].sum(axis=1), weights[:, 0].sum(axis=1)
        left_rows, left = rows.cumsum(axis=2), weights.cumsum(axis=2)
        right = whole[:, None, None] - left
        gain = _gini(whole)[:, None, None] - (
            left.sum(axis=-1) * _gini(left) + right.sum(axis=-1) * _gini(right)
        ) / np.maximum(whole.sum(axis=-1), 1e-300)[:, None, None]
        few, all_rows = left_rows.sum(axis=-1), whole_rows.sum(axis=-1)[:, None, None]
        least = max(1, self.how.min_rows)
        gain = np.where((few >= least) & (all_rows - few >= least), gain, -1.0).reshape(len(rows), -1)
        best = gain.argmax(axis=1)
        at = (np.arange(len(rows)), best // self.bins, best % self.bins)
        return np.column_stack([gain[at[0], best], at[1], at[2], whole_rows, whole, left_rows[at], left[at]])


def _gini(weights: np.ndarray) -> np.ndarray:
    total = weights.sum(axis=-1)
    return 1 - ((weights / np.where(total > 0, total, 1.0)[..., None]) ** 2).sum(axis=-1)


# ---- trees ------------------------------------------------------------------------------


class Tree:
    """Nodes as lists; children stand side by side, after their parent."""

    def __init__(self):
        self.feature, self.cut, self.child = [0], [255], [0]
        self.rows, self.weights, self.gain = [None], [None], [-1.0]

    def grow(self, node: int, found: np.ndarray, subset: np.ndarray) -> list[int]:
        """Learn a node's totals and, if a split gains, give it children; those that are not pure."""
        gain, at, cut = found[:3]
        self.rows[node], self.weights[node] = found[3:5], found[5:7]
        if not gain > 0:
            return []
        self.feature[node], self.cut[node], self.gain[node] = int(subset[int(at)]), int(cut), float(gain)
        self.child[node] = len(self.feature)
        sides = ((found[7:9], found[9:11]), (found[3:5] - found[7:9], found[5:7] - found[9:11]))
        # without rows of a class no weight either, whatever the subtraction left
        sides = [(rows, np.where(rows > 0, np.maximum(weights, 0.0), 0.0)) for rows, weights in sides]
        for rows, weights in sides:
            self.feature.append(0)
            self.cut.append(255)
            self.child.append(len(self.child))
            self.rows.append(rows)
            self.weights.append(weights)
            self.gain.append(-1.0)
        return [self.child[node] + i for i, (_, w) in enumerate(sides) if _gini(w) > SMALL]

    def table(self, number: int, cuts: list[np.ndarray]) -> list[tuple]:
        """Nodes left before right, numbered so; equal predictions below one parent are one leaf."""
        inner = [self.child[n] != n for n in range(len(self.child))]
        says = [float(w[1] > w[0]) for w in self.weights]
        for n in reversed(range(len(inner))):
            if inner[n]:
                one = self.child[n]
                if not inner[one] and not inner[one + 1] and says[one] == says[one + 1]:
                    inner[n] = False
        order, todo = [], [0]
        while todo:
            n = todo.pop()
            order.append(n)
            if inner[n]:
                todo += [self.child[n] + 1, self.child[n]]
        place = {n: at for at, n in enumerate(order)}
        out = []
        for n in order:
            weights, split = self.weights[n], inner[n]
            out.append(
                (
                    number, place[n], says[n], float(_gini(weights)), float(weights[0]), float(weights[1]),
                    int(self.rows[n].sum()), self.gain[n] if split else -1.0,
                    place[self.child[n]] if split else -1, place[self.child[n] + 1] if split else -1,
                    self.feature[n] if split else -1, float(cuts[self.feature[n]][self.cut[n]]) if split else 0.0,
                )
            )
        return out


def fit(
    df: DataFrame, how: Forest, label: str, key: str, features: str = "features", weight: Column | None = None
) -> tuple[list[Tree], list[np.ndarray]]:
    """The trees and the cuts of the features' bins."""
    rows = df.select(
        vector_to_array(features).alias("x"),
        F.coalesce(F.col(label).cast("double"), F.lit(0.0)).alias("label"),
        F.coalesce(weight if weight is not None else F.lit(1.0), F.lit(1.0)).cast("double").alias("weight"),
        F.xxhash64(key).alias("hash"),
    )
    classes = rows.groupBy("label").agg(F.count("*"), F.min("weight"), F.max("weight")).collect()
    count = sum(c[1] for c in classes)
    if not count:
        raise ValueError("a forest needs rows")
    even = all(c[2] == c[3] for c in classes)
    weight_of = {int(c["label"]): c[2] for c in classes}
    class_weights = (weight_of.get(0, 1.0), weight_of.get(1, 1.0)) if even else None
    cuts = feature_cuts(df, features, MAX_BINS)
    blocks = materialize(rows.mapInArrow(lambda b: _blocks(b, cuts), BLOCKS), "blocks", blocks=True)
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(2 * cores, -(-count // ROWS_PER_TASK)))
    read = blocks.coalesce(tasks).rdd if count * (len(cuts) + 17) <= KEPT_BYTES else blocks.rdd
    if count * (len(cuts) + 17) <= KEPT_BYTES:
        read = read.persist(StorageLevel.MEMORY_AND_DISK)
    trees = _grown(read, how, cuts, class_weights, min(cores, how.trees))
    read.unpersist()
    discard(blocks)
    return trees, cuts


def _grown(blocks, how: Forest, cuts: list[np.ndarray], class_weights, reducers: int) -> list[Tree]:
    features, bins = len(cuts), max(len(c) for c in cuts) + 1
    tried = how.tried(features)
    most = max(1, SUM_BYTES // (tried * bins * 2 * 8 * (1 if class_weights else 2)))  # nodes of a pass
    trees = [Tree() for _ in range(how.trees)]
    choose = Choice(how, tried, bins, class_weights)
    open_: dict[int, list[int]] = {t: [0] for t in range(how.trees)}
    for level in range(max(how.max_depth, 0) + 1):
        if not any(open_.values()) or (level == how.max_depth and level):
            break
        after: dict[int, list[int]] = {}
        for group in _groups(open_, most):
            walks, subsets = {}, {}
            for t, nodes in group.items():
                subsets[t] = np.stack([how.subset(features, t, n) for n in nodes])
                slot = np.full(len(trees[t].feature), -1)
                slot[nodes] = np.arange(len(nodes))
                grown = (np.array(a) for a in (trees[t].feature, trees[t].cut, trees[t].child))
                walks[t] = Walk(*grown, slot, subsets[t])
            counted = blocks.mapPartitions(Level(how, walks, features, bins, level, class_weights is None))
            best = counted.reduceByKey(np.add, min(reducers, len(group))).mapValues(choose).collect()
            for t, found in best:
                for line, node, subset in zip(found, group[t], subsets[t]):
                    if how.max_depth < 1:
                        line = np.concatenate([[-1.0], line[1:]])
                    after.setdefault(t, []).extend(trees[t].grow(node, line, subset))
        open_ = after
    return trees


def _groups(open_: dict[int, list[int]], most: int) -> Iterator[dict[int, list[int]]]:
    """Open nodes of the trees, so many at once; a node of a tree is in one group."""
    group, size = {}, 0
    for tree, nodes in sorted(open_.items()):
        for first in range(0, len(nodes), most):
            part = nodes[first : first + most]
            if size + len(part) > most:
                yield group
                group, size = {}, 0
            if part:
                group[tree] = part
                size += len(part)
    if group:
        yield group


# ---- as a stage of a pipeline -------------------------------------------------------------

NODES = "tree id prediction impurity zeros ones rows gain left right feature cut".split()


class ForestClassifier(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """A forest as above, as MLlib's model; ``settings`` are the fields of ``Forest`` as JSON."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "key column", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weight column, empty: none", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "fields of Forest as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", probabilityCol: str = "probability",
        rawPredictionCol: str = "rawPrediction", predictionCol: str = "prediction", labelCol: str = "label",
        keyCol: str = "key", weightCol: str = "", settings: str = "{}",
    ):
        super().__init__()
        self._setDefault(
            featuresCol="features", probabilityCol="probability", rawPredictionCol="rawPrediction",
            predictionCol="prediction", labelCol="label", keyCol="key", weightCol="", settings="{}",
        )
        self._set(**self._input_kwargs)

    def how(self) -> Forest:
        return Forest(**json.loads(self.getOrDefault(self.settings)))

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        get = lambda name: self.getOrDefault(self.getParam(name))
        how, weight = self.how(), F.col(get("weightCol")) if get("weightCol") else None
        trees, cuts = fit(dataset, how, get("labelCol"), get("keyCol"), get("featuresCol"), weight)
        columns = {name: get(name) for name in (*COLUMNS, "labelCol")}
        return _mllib(dataset, trees, cuts, how, columns, self.uid)


def _mllib(df: DataFrame, trees: Sequence[Tree], cuts, how: Forest, columns: dict, uid: str):
    """The trees in the form MLlib saves forests in, loaded."""
    spark, params = df.sparkSession, {"maxDepth": min(max(how.max_depth, 0), 30), "seed": how.seed, "impurity": "gini"}
    params |= {"minInstancesPerNode": max(1, how.min_rows), "maxBins": MAX_BINS}

    def facts(kind: str, own_uid: str, chosen: dict, **more) -> str:
        head = {
            "class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000),
            "sparkVersion": spark.version, "uid": own_uid, "paramMap": columns | params | chosen, "defaultParamMap": {},
        }
        return json.dumps(head | more)

    path = new_path(spark, "forest")
    chosen = {"numTrees": how.trees, "featureSubsetStrategy": str(how.max_features)}
    sizes = {"numFeatures": len(cuts), "numClasses": 2, "numTrees": len(trees)}
    text = facts("RandomForestClassificationModel", uid, chosen, **sizes)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    heads = [(t, facts("DecisionTreeClassificationModel", f"{uid}_{t}", {}), 1.0) for t in range(len(trees))]
    spark.createDataFrame(heads, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    lines = [line for number, tree in enumerate(trees) for line in tree.table(number, cuts)]
    whole = {"tree", "id", "rows", "left", "right", "feature"}
    table = pa.table(
        {name: pa.array(column, pa.int64() if name in whole else pa.float64()) for name, column in zip(NODES, zip(*lines))}
    )
    none = F.array().cast("array<double>")
    split = F.struct(
        F.col("feature").cast("int").alias("featureIndex"),
        F.when(F.col("feature") >= 0, F.array("cut")).otherwise(none).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    node = F.struct(
        F.col("id").cast("int").alias("id"), "prediction", "impurity", F.array("zeros", "ones").alias("impurityStats"),
        F.col("rows").alias("rawCount"), "gain", F.col("left").cast("int").alias("leftChild"),
        F.col("right").cast("int").alias("rightChild"), split.alias("split"),
    )
    nodes = spark.createDataFrame(table).select(F.col("tree").cast("int").alias("treeID"), node.alias("nodeData"))
    nodes.coalesce(1).write.parquet(f"{path}/data")
    model = RandomForestClassificationModel.load(path)
    saved = spark._jvm.org.apache.hadoop.fs.Path(path)
    saved.getFileSystem(spark._jsc.hadoopConfiguration()).delete(saved, True)
    return model
