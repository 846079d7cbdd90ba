"""Isolation forest as Spark jobs.

Each tree is grown from its own rows, 256 at most, by one task; scoring walks
all trees over Arrow batches.  The forest has at most trees x 511 nodes, so it
is broadcast whatever the size of the data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarescan.functions.columns import keyed_hash
from rarescan.operators.quantiles import exact_quantiles
from rarescan.operators.sampling import sample_rows
from rarescan.sources.shared import materialize

ROWS_PER_TREE = 256
ROWS_PER_WALK = 4096  # whose values stay in the cache while all trees are walked
NODES = "tree int, node int, slot int, cut double, left int, right int, size int"


def expected_path(n):
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=float)
    deep = np.maximum(n, 3.0) - 1.0
    long = 2.0 * (np.log(deep) + np.euler_gamma) - 2.0 * deep / (deep + 1.0)
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, long))


def grow_tree(rows: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Nodes (node, slot, cut, left, right, size) of one random tree; slot -1 = leaf."""
    limit = math.ceil(math.log2(max(2, len(rows))))
    nodes: list[tuple] = []
    todo = [(rows, 0, None, None)]
    while todo:
        part, depth, parent, side = todo.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent][side] = me
        low, high = part.min(axis=0), part.max(axis=0)
        open_slots = np.flatnonzero(high > low)
        if depth >= limit or len(part) <= 1 or not len(open_slots):
            nodes.append([me, -1, 0.0, -1, -1, len(part)])
            continue
        slot = int(rng.choice(open_slots))
        at = float(rng.uniform(low[slot], high[slot]))
        goes_left = part[:, slot] <= at
        nodes.append([me, slot, at, -1, -1, len(part)])
        todo.append((part[~goes_left], depth + 1, me, 4))
        todo.append((part[goes_left], depth + 1, me, 3))
    return [tuple(n) for n in nodes]


def walkable(forest: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
    """Where to go from each node of all trees; a leaf leads to itself, so that no step needs a mask.

    ``child`` holds a node's right, then its left child, ``length`` the adjusted path length of a
    leaf, ``levels`` the depth of each tree.
    """
    leaf = forest["slot"] < 0
    me = np.arange(len(leaf))
    offset = np.repeat(starts, np.diff(np.append(starts, len(leaf))))
    sides = [np.where(leaf, me, offset + forest[side]) for side in ("right", "left")]
    child = np.stack(sides, axis=1)
    depth = np.zeros(len(leaf), np.int64)
    level = starts
    while len(level):  # from the roots down
        inner = level[~leaf[level]]
        depth[child[inner]] = depth[inner, None] + 1
        level = child[inner].ravel()
    return {
        "slot": np.where(leaf, 0, forest["slot"]).astype(np.intp),
        "cut": forest["cut"].astype(float),
        "child": child.ravel().astype(np.intp),
        "length": np.where(leaf, depth + forest["tail"], 0.0),
        "starts": starts,
        "levels": np.maximum.reduceat(depth, starts),
    }


def walked_lengths(x: np.ndarray, walk: dict[str, np.ndarray]) -> np.ndarray:
    """As ``path_lengths``, some rows at a time, so that their values stay in the cache."""
    slot, cut, child, length = (walk[c] for c in ("slot", "cut", "child", "length"))
    total = np.zeros(len(x))
    for first in range(0, len(x), ROWS_PER_WALK):
        part = np.ascontiguousarray(x[first : first + ROWS_PER_WALK])
        values, rows = part.ravel(), np.arange(len(part)) * part.shape[1]
        lengths = total[first : first + ROWS_PER_WALK]
        for root, levels in zip(walk["starts"], walk["levels"]):
            at = np.full(len(part), root)
            for _ in range(levels):
                goes_left = values.take(rows + slot.take(at)) <= cut.take(at)
                at = child.take(2 * at + goes_left)
            lengths += length.take(at)
    return total / len(walk["starts"])


def path_lengths(x: np.ndarray, forest: dict[str, np.ndarray], starts: np.ndarray) -> np.ndarray:
    """Mean adjusted path length over all trees; ``starts`` are the root positions."""
    return walked_lengths(x, walkable(forest, starts))


def tree_samples(df: DataFrame, key: str, features: str, trees: int, salt: str) -> DataFrame:
    """(tree, x): rows for every tree, without repeats inside a tree.

    Large tables give each tree rows of its own.  A small table is shuffled
    anew as often as needed; every shuffle serves rows/256 trees.
    """
    wanted = df.select(key, vector_to_array(features).alias("x"))
    pool = materialize(sample_rows(wanted, key, trees * ROWS_PER_TREE, salt), "tree-rows")
    n = pool.count()  # at most trees * 256 rows from here on
    per_shuffle = max(1, n // ROWS_PER_TREE)
    shuffles = math.ceil(trees / per_shuffle)
    order = keyed_hash(F.concat_ws(":", F.col(key), F.col("shuffle")), f"{salt}-trees")
    place = F.row_number().over(Window.partitionBy("shuffle").orderBy(order, key)) - 1
    return (
        pool.withColumn("shuffle", F.explode(F.sequence(F.lit(0), F.lit(shuffles - 1))))
        .withColumn("place", place)
        .withColumn(
            "tree",
            (F.col("shuffle") * per_shuffle + F.floor(F.col("place") / ROWS_PER_TREE)).cast("int"),
        )
        .where(
            (F.col("place") < per_shuffle * ROWS_PER_TREE) & (F.col("tree") < trees)
        )
        .select("tree", "place", "x")
    )


def grow_forest(samples: DataFrame, seed: int) -> DataFrame:
    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        rows = np.stack(group.sort_values("place")["x"].to_numpy())
        nodes = grow_tree(rows, np.random.default_rng([seed, tree]))
        out = pd.DataFrame(nodes, columns=["node", "slot", "cut", "left", "right", "size"])
        out.insert(0, "tree", tree)
        return out

    return samples.groupBy("tree").applyInPandas(grow, NODES)


def anomaly_score(nodes: pd.DataFrame, rows_per_tree: int):
    """A column function: features vector -> 2^(-mean path / expected path)."""
    nodes = nodes.sort_values(["tree", "node"])
    forest = {c: nodes[c].to_numpy() for c in ("slot", "cut", "left", "right")}
    forest["tail"] = np.where(nodes["slot"] < 0, expected_path(nodes["size"]), 0.0)
    walk = walkable(forest, np.flatnonzero(nodes["node"].to_numpy() == 0))
    scale = float(expected_path(rows_per_tree))

    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        matrix = np.stack(x.to_numpy())
        return pd.Series(np.exp2(-walked_lengths(matrix, walk) / scale))

    return score


class IsolationForest(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Unsupervised anomaly scores in [0, 1], scaled by the range on the fitted rows."""

    keyCol = Param(Params._dummy(), "keyCol", "key column", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "output column", TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    contamination = Param(
        Params._dummy(), "contamination", "share of rows to flag", TypeConverters.toFloat
    )
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        keyCol: str = "key",
        featuresCol: str = "features",
        scoreCol: str = "score",
        trees: int = 200,
        contamination: float = 0.01,
        seed: int = 42,
    ):
        super().__init__()
        self._setDefault(
            keyCol="key",
            featuresCol="features",
            scoreCol="score",
            trees=200,
            contamination=0.01,
            seed=42,
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> IsolationForestModel:
        get = self.getOrDefault
        key, features, seed = get(self.keyCol), get(self.featuresCol), get(self.seed)
        samples = tree_samples(dataset, key, features, get(self.trees), str(seed))
        # trees x 511 nodes at most
        nodes = grow_forest(samples, seed).toPandas()
        size = int(nodes.loc[nodes["node"] == 0, "size"].max())
        raw = anomaly_score(nodes, size)(vector_to_array(features))
        # Written once: the trees are walked a single time per row.
        scored = materialize(dataset.select(raw.alias("raw")), "isolation")
        low, high = scored.agg(F.min("raw"), F.max("raw")).first()
        limit = exact_quantiles(scored, ["raw"], [1 - get(self.contamination)])["raw"][0]
        model = IsolationForestModel(
            featuresCol=features,
            scoreCol=get(self.scoreCol),
            rowsPerTree=size,
            low=low,
            high=high,
            limit=limit,
        )
        model.nodes = nodes
        return model._resetUid(self.uid)


class _NodesWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        spark = self.sparkSession
        spark.createDataFrame(self.instance.nodes, NODES).write.parquet(f"{path}/nodes")


class _NodesReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.nodes = self.sparkSession.read.parquet(f"{path}/nodes").toPandas()
        return model


class IsolationForestModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "output column", TypeConverters.toString)
    rowsPerTree = Param(Params._dummy(), "rowsPerTree", "rows per tree", TypeConverters.toInt)
    low = Param(Params._dummy(), "low", "lowest raw score", TypeConverters.toFloat)
    high = Param(Params._dummy(), "high", "highest raw score", TypeConverters.toFloat)
    limit = Param(Params._dummy(), "limit", "raw score to flag above", TypeConverters.toFloat)

    nodes: pd.DataFrame

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol: str | None = None,
        scoreCol: str | None = None,
        rowsPerTree: int | None = None,
        low: float | None = None,
        high: float | None = None,
        limit: float | None = None,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        raw = anomaly_score(self.nodes, get(self.rowsPerTree))
        low, high = get(self.low), get(self.high)
        width = high - low if high > low else 1.0
        scaled = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("__path_score") - low) / width))
        return (
            dataset.withColumn("__path_score", raw(vector_to_array(get(self.featuresCol))))
            .withColumns(
                {
                    get(self.scoreCol): scaled,
                    "prediction": (F.col("__path_score") > get(self.limit)).cast("double"),
                }
            )
            .drop("__path_score")
        )

    def write(self):
        return _NodesWriter(self)

    @classmethod
    def read(cls):
        return _NodesReader(cls)
