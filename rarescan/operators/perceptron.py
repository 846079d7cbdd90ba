"""Multilayer perceptrons for two classes: row weights, Adam, early stopping, many in one pass.

Rows are written once as blocks, dealt by a hash of their key to the steps of an epoch and to
a validation part that no step sees.  A step reads its own blocks alone: every task sums
loss, weight and gradient of its rows, Spark adds the tasks' sums, and the driver moves the
weights, whose number depends on the layers, not on the rows.  An epoch has ``rows / batch``
steps, ``MOST_STEPS`` at most: beyond, its batches grow with the table.  Networks, be it
candidates of a search, folds or both, are an axis of the sums and share every pass.

The loss is the weighted mean of the log loss; a step adds ``alpha / 2`` of the squared
weights (biases are free) over ``batch``, whatever the batch's real size.  After each epoch
the loss of the validation part is taken; a network stops when it has not fallen by
``tolerance`` for ``patience`` epochs and keeps the weights of its best one.

Defined cases: rows without label or weight count as 0 and 1; a null or NaN feature is 0; rows of
equal keys fall into the same part; without validation rows the training loss decides; without rows
the first weights stay.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarescan.sources.shared import discard, materialize

MOST_STEPS = 16
ROWS_PER_TASK = 32_768
BLOCK_BYTES = 1 << 20  # of a block, about: a task holds few of them
VALIDATION_PARTS = 10  # one of them is the validation part
KEPT_BYTES = 256_000_000  # of a core's blocks in memory, before they are packed
SUM_BYTES = 128_000_000  # of all networks' sums at once, per task and on the driver
DECAY, SQUARE_DECAY, TINY = 0.9, 0.999, 1e-8  # Adam

BLOCKS = "n int, x binary, label binary, weight binary, fold binary, step int"
WEIGHTS = "layer int, source int, target int, value double"


@dataclass(frozen=True)
class Perceptron:
    """How one network is fitted; ``without_fold`` leaves the rows of a fold out, ``class_weights``
    multiply the weights of its rows."""

    hidden: tuple[int, ...] = (64, 32)
    activation: str = "relu"  # or "tanh"
    alpha: float = 1e-4
    learning_rate: float = 1e-3
    batch: int = 256
    epochs: int = 500
    patience: int = 15
    tolerance: float = 1e-4
    seed: int = 42
    without_fold: int | None = None
    class_weights: tuple[float, float] = (1.0, 1.0)

    def __post_init__(self):
        if self.activation not in ("relu", "tanh"):
            raise ValueError(f"unknown activation {self.activation}")

    def sizes(self, features: int) -> list[int]:
        return [features, *self.hidden, 1]

    def start(self, features: int) -> np.ndarray:
        """Uniform weights, their range set by the units that a layer joins."""
        random, sizes = np.random.default_rng(self.seed), self.sizes(features)
        spread = 6.0 if self.activation == "relu" else 2.0
        parts = []
        for inner, outer in zip(sizes, sizes[1:]):
            bound = np.sqrt(spread / (inner + outer))
            parts.append(random.uniform(-bound, bound, (inner + 1) * outer))
        return np.concatenate(parts)


# ---- one network ----------------------------------------------------------------------


def layers_of(flat: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights and biases per layer, as views of the flat vector."""
    out, at = [], 0
    for inner, outer in zip(sizes, sizes[1:]):
        matrix = flat[at : at + (inner + 1) * outer].reshape(inner + 1, outer)
        out.append((matrix[:-1], matrix[-1]))
        at += (inner + 1) * outer
    return out


def _outputs(layers: list, x: np.ndarray, activation: str) -> list[np.ndarray]:
    """The values of all layers; the last are margins."""
    values = [x]
    for depth, (weights, biases) in enumerate(layers, 1):
        z = values[-1] @ weights + biases
        if depth < len(layers):
            z = np.maximum(z, 0.0) if activation == "relu" else np.tanh(z)
        values.append(z)
    return values


def margins(flat: np.ndarray, sizes: Sequence[int], activation: str, x: np.ndarray) -> np.ndarray:
    return _outputs(layers_of(flat, sizes), x, activation)[-1][:, 0]


def sums(
    flat: np.ndarray, sizes: Sequence[int], activation: str, x: np.ndarray, y: np.ndarray, w: np.ndarray
) -> tuple[float, np.ndarray]:
    """The weighted sum of the log loss and its gradient."""
    layers = layers_of(flat, sizes)
    values = _outputs(layers, x, activation)
    margin = values[-1][:, 0]
    loss = float(w @ (np.logaddexp(0.0, margin) - y * margin))
    gradient = np.empty_like(flat)
    places = layers_of(gradient, sizes)
    back = (w * (0.5 * (1 + np.tanh(margin / 2)) - y))[:, None]
    for depth in range(len(layers) - 1, -1, -1):
        into = values[depth]
        places[depth][0][:], places[depth][1][:] = into.T @ back, back.sum(axis=0)
        if depth:
            slope = into > 0 if activation == "relu" else 1 - into * into
            back = (back @ layers[depth][0].T) * slope
    return loss, gradient


# ---- passes over the rows ---------------------------------------------------------------


def sliced(batches: Iterator[pa.RecordBatch], row_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows that a block of them is small."""
    most = max(1, BLOCK_BYTES // max(1, row_bytes))
    for batch in batches:
        for first in range(0, batch.num_rows, most):
            yield batch.slice(first, most)


def packed(x: np.ndarray) -> bytes:
    """Rows of numbers: columns of small whole numbers take a byte each, others eight."""
    with np.errstate(invalid="ignore"):
        small = x.astype(np.int8)
    flat = (small == x).all(axis=0)
    return flat.astype(np.uint8).tobytes() + small[:, flat].tobytes() + x[:, ~flat].tobytes()


def unpacked(found: bytes, rows: int, columns: int, ones: int = 0) -> np.ndarray:
    """What ``packed`` was given, and ``ones`` more columns of ones."""
    flat = np.frombuffer(found, np.uint8, columns).astype(bool)
    few = int(flat.sum())
    small = np.frombuffer(found, np.int8, rows * few, columns).reshape(rows, few)
    large = np.frombuffer(found[columns + rows * few :], np.float64).reshape(rows, columns - few)
    x = np.ones((rows, columns + ones))
    x[:, np.flatnonzero(flat)] = small
    x[:, np.flatnonzero(~flat)] = large
    return x


def _blocks(batches: Iterator[pa.RecordBatch], features: int, steps: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, (8 * features + 20) // steps):  # a batch gives a block per step
        whole = lambda name, kind: batch[name].to_numpy(zero_copy_only=False).astype(kind)  # noqa: E731,B023
        x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, features)
        x = np.nan_to_num(x.astype(np.float64))
        columns = [whole("label", np.float64), whole("weight", np.float64), whole("fold", np.int32)]
        step = whole("step", np.int32)
        found = [(s, np.flatnonzero(step == s)) for s in np.unique(step)]
        arrays = [pa.array([len(at) for _, at in found], pa.int32())]
        arrays.append(pa.array([packed(x[at]) for _, at in found], pa.binary()))
        arrays += [pa.array([c[at].tobytes() for _, at in found], pa.binary()) for c in columns]
        arrays.append(pa.array([s for s, _ in found], pa.int32()))
        yield pa.record_batch(arrays, ["n", "x", "label", "weight", "fold", "step"])


@dataclass(frozen=True)
class Pass:
    """What the tasks of a step sum: per network loss, weight and, if asked for, gradient."""

    hows: dict[int, Perceptron]
    weights: dict[int, np.ndarray]
    features: int
    gradient: bool = True

    def __call__(self, rows: Iterator) -> Iterator[dict[int, np.ndarray]]:
        total: dict[int, np.ndarray] = {}
        for row in rows:
            read = lambda name, kind: np.frombuffer(row[name], kind)  # noqa: E731,B023
            x = unpacked(row["x"], row["n"], self.features)
            label, weight, fold = read("label", np.float64), read("weight", np.float64), read("fold", np.int32)
            for model, how in self.hows.items():
                w = weight * np.where(label > 0, how.class_weights[1], how.class_weights[0])
                if how.without_fold is not None:
                    w = w * (fold != how.without_fold)
                sizes, flat = how.sizes(self.features), self.weights[model]
                if self.gradient:
                    loss, slope = sums(flat, sizes, how.activation, x, label, w)
                    found = np.concatenate([[loss, w.sum()], slope])
                else:
                    m = margins(flat, sizes, how.activation, x)
                    found = np.array([w @ (np.logaddexp(0.0, m) - label * m), w.sum()])
                total[model] = total[model] + found if model in total else found
        yield total


def _added(one: dict[int, np.ndarray], other: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    for model, found in other.items():
        one[model] = one[model] + found if model in one else found
    return one


class Rows:
    """The written blocks of a table, one persisted set per step and one of the validation part."""

    def __init__(
        self, df: DataFrame, label: str, key: str, features: str, weight: Column | None, fold: str | None,
        batch: int, validation: bool = True, seed: int = 42,
    ):
        found = df.agg(F.count("*").alias("n"), F.first(F.size(vector_to_array(features))).alias("width")).first()
        self.features, count = found["width"] or 0, found["n"]
        self.steps = max(1, min(MOST_STEPS, -(-count // batch)))
        part = F.pmod(F.xxhash64(F.lit(f"{seed}-part"), F.col(key)), F.lit(VALIDATION_PARTS))
        step = F.pmod(F.xxhash64(F.lit(f"{seed}-step"), F.col(key)), F.lit(self.steps))
        rows = df.select(
            vector_to_array(features).alias("x"),
            F.coalesce(F.col(label).cast("double"), F.lit(0.0)).alias("label"),
            F.coalesce(weight if weight is not None else F.lit(1.0), F.lit(1.0)).cast("double").alias("weight"),
            F.coalesce(F.col(fold).cast("int") if fold else F.lit(-1), F.lit(-1)).alias("fold"),
            (F.when(part == 0, self.steps).otherwise(step) if validation else step).cast("int").alias("step"),
        )
        width, steps = self.features, self.steps
        self.blocks = materialize(rows.mapInArrow(lambda b: _blocks(b, width, steps), BLOCKS), "blocks", ("step",), blocks=True)
        cores = df.sparkSession.sparkContext.defaultParallelism
        tasks = max(1, min(2 * cores, -(-count // (ROWS_PER_TASK * self.steps))))
        # very many small jobs: no plan each time; a lost block is read again, as are blocks that memory would not hold
        self.kept = count * (8 * width + 20) <= KEPT_BYTES * cores
        self.parts = [self.blocks.where(F.col("step") == s).coalesce(tasks).rdd for s in range(self.steps + 1)]
        if self.kept:
            self.parts = [part.persist(StorageLevel.MEMORY_AND_DISK) for part in self.parts]

    def take(self, step: int, what: Pass) -> dict[int, np.ndarray]:
        """One stage while there are few tasks, a tree of sums when there are many."""
        return self.parts[step].mapPartitions(what).treeAggregate({}, _added, _added)

    def close(self) -> None:
        for part in self.parts if self.kept else ():
            part.unpersist()
        discard(self.blocks)


# ---- fitting ------------------------------------------------------------------------------


@dataclass
class Trained:
    """A fitted network and, per epoch, the mean loss of its steps and of the validation part."""

    how: Perceptron
    features: int
    flat: np.ndarray
    losses: list[tuple[float, float]] = field(default_factory=list)

    def weights(self) -> pd.DataFrame:
        """One row per connection; source -1 is the bias."""
        frames = []
        for layer, (matrix, biases) in enumerate(layers_of(self.flat, self.how.sizes(self.features))):
            whole = np.vstack([biases, matrix])
            source, target = np.indices(whole.shape)
            columns = {"source": source.ravel() - 1, "target": target.ravel(), "value": whole.ravel()}
            frames.append(pd.DataFrame({"layer": layer, **columns}))
        return pd.concat(frames, ignore_index=True).astype({"layer": int, "source": int, "target": int})


class _Growing:
    """The state of one network between steps."""

    def __init__(self, how: Perceptron, features: int):
        self.how, self.done = how, how.epochs <= 0
        self.flat = how.start(features)
        self.mean, self.square, self.moves = np.zeros_like(self.flat), np.zeros_like(self.flat), 0
        penal = [np.vstack([np.ones_like(m), np.zeros((1, len(b)))]).ravel() for m, b in layers_of(self.flat, how.sizes(features))]
        self.penalised = np.concatenate(penal)
        self.best, self.best_flat, self.waited = np.inf, self.flat, 0
        self.losses: list[tuple[float, float]] = []
        self.epoch = np.zeros(2)

    def move(self, found: np.ndarray | None) -> None:
        if found is None or found[1] <= 0:
            return
        self.epoch += found[:2]
        slope = found[2:] / found[1] + self.how.alpha / self.how.batch * self.penalised * self.flat
        self.moves += 1
        self.mean = DECAY * self.mean + (1 - DECAY) * slope
        self.square = SQUARE_DECAY * self.square + (1 - SQUARE_DECAY) * slope**2
        rate = self.how.learning_rate * np.sqrt(1 - SQUARE_DECAY**self.moves) / (1 - DECAY**self.moves)
        self.flat = self.flat - rate * self.mean / (np.sqrt(self.square) + TINY)

    def end_epoch(self, found: np.ndarray | None) -> None:
        trained = self.epoch[0] / self.epoch[1] if self.epoch[1] > 0 else 0.0
        held = found[0] / found[1] if found is not None and found[1] > 0 else trained
        self.losses.append((float(trained), float(held)))
        self.epoch = np.zeros(2)
        self.waited = 0 if held < self.best - self.how.tolerance else self.waited + 1
        if held < self.best:
            self.best, self.best_flat = held, self.flat
        self.done = len(self.losses) >= self.how.epochs or self.waited >= self.how.patience


def fit(
    df: DataFrame,
    hows: Sequence[Perceptron],
    label: str,
    key: str,
    features: str = "features",
    weight: Column | None = None,
    fold: str | None = None,
) -> list[Trained]:
    """One network per entry of ``hows``; those of one batch size share their passes over ``df``."""
    out: dict[int, Trained] = {}
    for batch in sorted({h.batch for h in hows}):
        rows = Rows(df, label, key, features, weight, fold, batch)
        mine = [n for n, h in enumerate(hows) if h.batch == batch]
        widest = max(8 * len(hows[n].start(rows.features)) for n in mine)
        together = max(1, SUM_BYTES // widest)
        for first in range(0, len(mine), together):
            out |= _fit_together(rows, {n: hows[n] for n in mine[first : first + together]})
        rows.close()
    return [out[n] for n in range(len(hows))]


def _fit_together(rows: Rows, hows: dict[int, Perceptron]) -> dict[int, Trained]:
    growing = {n: _Growing(how, rows.features) for n, how in hows.items()}
    order = np.random.default_rng(0)
    while left := {n: g for n, g in growing.items() if not g.done}:
        open_hows = {n: hows[n] for n in left}
        for step in order.permutation(rows.steps):
            found = rows.take(int(step), Pass(open_hows, {n: g.flat for n, g in left.items()}, rows.features))
            for n, g in left.items():
                g.move(found.get(n))
        check = Pass(open_hows, {n: g.flat for n, g in left.items()}, rows.features, gradient=False)
        found = rows.take(rows.steps, check)
        for n, g in left.items():
            g.end_epoch(found.get(n))
    return {n: Trained(g.how, rows.features, g.best_flat, g.losses) for n, g in growing.items()}


def gradients(
    df: DataFrame,
    networks: Sequence[tuple[Perceptron, np.ndarray]],
    label: str,
    key: str,
    features: str = "features",
    weight: Column | None = None,
) -> list[tuple[float, np.ndarray]]:
    """Mean loss and gradient of given networks over all rows, all in one pass."""
    rows = Rows(df, label, key, features, weight, None, 1 << 62, validation=False)
    what = Pass({n: h for n, (h, _) in enumerate(networks)}, {n: f for n, (_, f) in enumerate(networks)}, rows.features)
    found = rows.take(0, what)
    rows.close()
    none = [np.zeros(2 + len(flat)) for _, flat in networks]
    taken = [found.get(n, none[n]) for n in range(len(networks))]
    return [(float(t[0] / max(t[1], 1e-300)), t[2:] / max(t[1], 1e-300)) for t in taken]


# ---- as a stage of a pipeline -----------------------------------------------------------


def margin_udf(weights: pd.DataFrame, activation: str):
    """A column function: features as an array -> margin."""
    layers = []
    for _, layer in weights.sort_values(["layer", "source", "target"]).groupby("layer"):
        matrix = layer["value"].to_numpy().reshape(-1, layer["target"].max() + 1)
        layers.append((matrix[1:], matrix[0]))

    @F.pandas_udf(T.DoubleType())
    def margin(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        return pd.Series(_outputs(layers, np.nan_to_num(np.stack(x.to_numpy())), activation)[-1][:, 0])

    return margin


class _Columns(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "vector of both", TypeConverters.toString)
    rawPredictionCol = Param(Params._dummy(), "rawPredictionCol", "margins", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "class", TypeConverters.toString)


COLUMNS = ("featuresCol", "probabilityCol", "rawPredictionCol", "predictionCol")


class PerceptronClassifier(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """A perceptron as above; ``settings`` are the fields of ``Perceptron`` as JSON."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "key column", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weight column, empty: none", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "fields of Perceptron as JSON", TypeConverters.toString)

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

    def how(self) -> Perceptron:
        given = json.loads(self.getOrDefault(self.settings))
        return Perceptron(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})

    def model_of(self, trained: Trained) -> PerceptronModel:
        names = {c: self.getOrDefault(self.getParam(c)) for c in COLUMNS}
        model = PerceptronModel(activation=trained.how.activation, **names)
        model.weights = trained.weights()
        return model

    def _fit(self, dataset: DataFrame) -> PerceptronModel:
        get = lambda name: self.getOrDefault(self.getParam(name))
        weight = F.col(get("weightCol")) if get("weightCol") else None
        (trained,) = fit(dataset, [self.how()], get("labelCol"), get("keyCol"), get("featuresCol"), weight)
        return self.model_of(trained)._resetUid(self.uid)


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.sparkSession.createDataFrame(self.instance.weights, WEIGHTS).write.parquet(f"{path}/weights")


class _Reader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.weights = self.sparkSession.read.parquet(f"{path}/weights").toPandas()
        return model


class PerceptronModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    activation = Param(Params._dummy(), "activation", "of the hidden layers", TypeConverters.toString)

    weights: pd.DataFrame

    @keyword_only
    def __init__(
        self, *, featuresCol: str | None = None, probabilityCol: str | None = None,
        rawPredictionCol: str | None = None, predictionCol: str | None = None, activation: str | None = None,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = lambda name: self.getOrDefault(self.getParam(name))
        margin = margin_udf(self.weights, get("activation"))(vector_to_array(get("featuresCol")))
        m = F.col("__margin")
        p = 1 / (1 + F.exp(-m))
        outputs = {
            get("rawPredictionCol"): array_to_vector(F.array(-m, m)),
            get("probabilityCol"): array_to_vector(F.array(1 - p, p)),
            get("predictionCol"): (m > 0).cast("double"),
        }
        return dataset.withColumn("__margin", margin).withColumns(outputs).drop("__margin")

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)
