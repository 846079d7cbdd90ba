"""Penalised logistic regression by proximal Newton steps, many models in the same passes.

A model minimises ``C`` times the weighted sum of the log loss plus the penalty of its
coefficients: half their squares (l2) or their sizes (l1).  The intercept is the coefficient
of a column of ones and is penalised like the others.

A pass sums, per model and task, loss, gradient and the Gram matrix of the columns weighted
by the loss's curvature; Spark adds the tasks' sums.  Their size is the square of the number of
columns, whatever the rows.  The driver minimises the quadratic model they give plus the penalty:
one linear system for l2, coordinate descent for l1.  A step that does not lower the objective enough is
halved.  The sums do not depend on ``C``: models that differ in nothing else are one path, from the
smallest ``C`` up, each starting where the last one ended, from the sums already taken.  Paths,
be it folds, penalties or both, are an axis of the sums and share every pass.

Defined cases: rows without label or weight count as 0 and 1; a NaN feature is 0 (the vectors themselves
are never null, as the assembly gives none); a column of zeros coefficient 0; without rows all are 0; a path that reaches ``max_iter`` keeps what it has.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasLabelCol,
    HasPredictionCol,
    HasProbabilityCol,
    HasRawPredictionCol,
    HasWeightCol,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarescan.operators.perceptron import SUM_BYTES, Rows, unpacked

ENOUGH = 1e-4  # share of the expected fall that a step must reach
NOISE = 1e-12  # share of the objective that sums of doubles may differ by
SHORTEST = 1e-9
SWEEPS = 20_000
ALL_ROWS = 1 << 62


@dataclass(frozen=True)
class Logistic:
    """How one model is fitted; ``without_fold`` leaves the rows of a fold out, ``class_weights``
    multiply the weights of its rows."""

    C: float = 0.1
    penalty: str = "l2"  # or "l1"
    max_iter: int = 1000
    tolerance: float = 1e-8
    without_fold: int | None = None
    class_weights: tuple[float, float] = (1.0, 1.0)

    def __post_init__(self):
        if self.penalty not in ("l1", "l2"):
            raise ValueError(f"unknown penalty {self.penalty}")
        if not self.C > 0:
            raise ValueError("C must be positive")

    def penalty_of(self, b: np.ndarray) -> float:
        return float(np.abs(b).sum() if self.penalty == "l1" else b @ b / 2)


@dataclass
class Fitted:
    """``steps`` counts the passes of the model's path up to it."""

    how: Logistic
    coefficients: np.ndarray
    intercept: float
    steps: int


# ---- passes over the rows ---------------------------------------------------------------


def sums(b: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Loss, gradient and Gram matrix, one after the other; the last column of ``x`` is ones."""
    margin = x @ b
    p = 0.5 * (1 + np.tanh(margin / 2))
    loss = w @ (np.logaddexp(0.0, margin) - y * margin)
    bent = x * np.sqrt(w * p * (1 - p))[:, None]
    gram = bent.T @ bent  # one matrix with itself: half the work
    return np.concatenate([[loss], x.T @ (w * (p - y)), gram.ravel()])


@dataclass(frozen=True)
class Pass:
    """What the tasks of a pass sum, per path."""

    hows: dict[int, Logistic]
    at: dict[int, np.ndarray]
    features: int

    def __call__(self, rows: Iterator) -> Iterator[dict[int, np.ndarray]]:
        total: dict[int, np.ndarray] = {}
        for row in rows:
            read = lambda name, kind: np.frombuffer(row[name], kind)  # noqa: E731,B023
            x = unpacked(row["x"], row["n"], self.features, 1)
            label, weight, fold = read("label", np.float64), read("weight", np.float64), read("fold", np.int32)
            parts: dict[int | None, tuple] = {None: (x, label, weight)}  # by the fold left out
            for path, how in self.hows.items():
                if how.without_fold not in parts:
                    inside = fold != how.without_fold
                    parts[how.without_fold] = x[inside], label[inside], weight[inside]
                own, y, w = parts[how.without_fold]
                w = w * np.where(y > 0, how.class_weights[1], how.class_weights[0])
                found = sums(self.at[path], own, y, w)
                total[path] = total[path] + found if path in total else found
        yield total


# ---- steps on the driver ----------------------------------------------------------------


def _soft(value: float, by: float) -> float:
    return max(value - by, 0.0) + min(value + by, 0.0)


def _active(b: np.ndarray, slope: np.ndarray, curve: np.ndarray, near: np.ndarray) -> np.ndarray | None:
    """The l1 minimum if it has the signs of ``near``; None if it has not, or is not one point."""
    some = np.flatnonzero(near)
    signs = np.sign(near[some])
    inside = curve[np.ix_(some, some)]
    if len(some) and np.linalg.cond(inside) > 1e12:
        return None
    found = np.zeros_like(b)
    found[some] = np.linalg.solve(inside, curve[some] @ b - slope[some] - signs)
    left = slope + curve @ (found - b)
    left[some] = 0.0
    return found if np.all(np.sign(found[some]) == signs) and np.all(np.abs(left) <= 1 + 1e-9) else None


def _sign_search(b: np.ndarray, slope: np.ndarray, curve: np.ndarray) -> np.ndarray | None:
    """The l1 minimum by whole systems over the columns in use; None if the turns run out.

    Between zeros the objective is quadratic: a turn goes to its minimum, or past a zero on the way if that is lower,
    then lets in the column that gains most. Columns that others make up leave along the direction without curvature.
    """
    at = np.where(np.diag(curve) > 1e-300, b, 0.0)

    def value(x: np.ndarray) -> float:
        return float(slope @ (x - b) + (x - b) @ curve @ (x - b) / 2 + np.abs(x).sum())

    for _ in range(20 * len(b) + 100):
        left = slope + curve @ (at - b)
        some = np.flatnonzero(at)
        pull = left[some] + np.sign(at[some])
        if np.abs(pull).max(initial=0) <= 1e-9:
            over = np.where(at == 0, np.abs(left), 0.0)
            j = int(over.argmax())
            if over[j] <= 1 + 1e-9:
                return at
            at[j] = _soft(-left[j] / curve[j, j], 1 / curve[j, j])
            continue
        bends, ways = np.linalg.eigh(curve[np.ix_(some, some)])
        flat = bends <= 1e-12 * bends[-1]
        along = ways.T @ -pull
        lost = ways[:, flat] @ along[flat]
        free = np.abs(lost).max(initial=0) > 1e-9  # falls without end, up to a zero
        step = lost if free else ways[:, ~flat] @ (along[~flat] / bends[~flat])
        with np.errstate(divide="ignore", invalid="ignore"):
            turns = -at[some] / step
        ends = sorted({float(t) for t in turns if 0 < t < (np.inf if free else 1)} | (set() if free else {1.0}))
        best, lowest = None, value(at)
        for t in ends:
            new = at.copy()
            new[some] = np.where(turns == t, 0.0, at[some] + t * step)
            if (found := value(new)) < lowest or best is None:
                best, lowest = new, found
            else:
                break  # convex along the way
        if best is None or np.array_equal(best, at):
            return None
        at = best
    return None


def newton_step(how: Logistic, b: np.ndarray, slope: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """From ``b`` to the minimum of the quadratic model of the loss plus the penalty."""
    slope, curve = how.C * slope, how.C * gram
    if how.penalty == "l2":
        return -np.linalg.solve(curve + np.eye(len(b)), slope + b)
    if (exact := _sign_search(b, slope, curve)) is not None:
        return exact - b
    at, left = b.copy(), slope.copy()  # left: slope of the quadratic model at ``at``
    for sweep in range(SWEEPS):
        most = 0.0
        for j in range(len(b)):
            bend = curve[j, j]
            new = _soft(at[j] - left[j] / bend, 1 / bend) if bend > 1e-300 else 0.0
            if new != at[j]:
                left = left + curve[:, j] * (new - at[j])
                most = max(most, abs(new - at[j]))
                at[j] = new
        if sweep % 10 == 9 and (exact := _active(b, slope, curve, at)) is not None:
            return exact - b
        if most <= 1e-3 * how.tolerance * max(1.0, float(np.abs(at).max(initial=0))):
            break
    return at - b


class _Path:
    """Models that differ in ``C`` alone, and where the one being fitted stands."""

    def __init__(self, members: list[tuple[int, Logistic]], columns: int):
        self.members = sorted(members, key=lambda m: m[1].C)
        self.at = np.zeros(columns)  # the point of the next pass
        self.done: dict[int, Fitted] = {}
        self.steps = self.tried = 0
        self._start()

    def _start(self) -> None:
        self.how = self.members[len(self.done)][1] if len(self.done) < len(self.members) else None
        self.base, self.tried = None, 0

    def _end(self, b: np.ndarray) -> None:
        number, how = self.members[len(self.done)]
        self.done[number] = Fitted(how, b[:-1].copy(), float(b[-1]), self.steps)
        self._start()

    def move(self, found: np.ndarray | None) -> None:
        self.steps += 1
        size = len(self.at)
        if found is None:  # no rows
            found = np.zeros(1 + size + size * size)
        loss, slope, gram = found[0], found[1 : 1 + size], found[1 + size :].reshape(size, size)
        while self.how is not None:
            how = self.how
            self.tried += 1
            value = how.C * loss + how.penalty_of(self.at)
            if self.base is not None:
                before, b, step, fall, length = self.base
                if value > before + ENOUGH * length * fall + NOISE * abs(before):
                    length /= 2
                    if length < SHORTEST or self.tried >= how.max_iter:
                        self.at = b
                        self._end(b)
                        return  # the sums are those of another point
                    self.base, self.at = (before, b, step, fall, length), b + length * step
                    return
            b, step = self.at, newton_step(how, self.at, slope, gram)
            small = np.abs(step).max(initial=0) <= how.tolerance * max(1.0, np.abs(b).max(initial=0))
            if not small and self.tried < how.max_iter:
                fall = how.C * slope @ step + how.penalty_of(b + step) - how.penalty_of(b)
                self.base, self.at = (value, b, step, fall, 1.0), b + step
                return
            self._end(b + step if small else b)  # the next one starts from these sums


def fit(
    df: DataFrame,
    hows: Sequence[Logistic],
    label: str,
    key: str,
    features: str = "features",
    weight: Column | None = None,
    fold: str | None = None,
) -> list[Fitted]:
    """One model per entry of ``hows``, all fitted in the same passes over ``df``."""
    rows = Rows(df, label, key, features, weight, fold, ALL_ROWS, validation=False)
    columns = rows.features + 1
    alike: dict[tuple, list[tuple[int, Logistic]]] = defaultdict(list)
    for n, how in enumerate(hows):
        alike[how.penalty, how.without_fold, how.class_weights, how.max_iter, how.tolerance].append((n, how))
    paths = [_Path(members, columns) for members in alike.values()]
    together = max(1, SUM_BYTES // (8 * (1 + columns + columns * columns)))
    for first in range(0, len(paths), together):
        some = dict(enumerate(paths[first : first + together]))
        while left := {n: p for n, p in some.items() if p.how is not None}:
            found = rows.take(0, Pass({n: p.how for n, p in left.items()}, {n: p.at for n, p in left.items()}, rows.features))
            for n, path in left.items():
                path.move(found.get(n))
    rows.close()
    done = {n: fitted for path in paths for n, fitted in path.done.items()}
    return [done[n] for n in range(len(hows))]


# ---- as a stage of a pipeline -----------------------------------------------------------


class _Columns(HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    pass


COLUMNS = ("featuresCol", "probabilityCol", "rawPredictionCol", "predictionCol")


class PenalisedLogistic(
    Estimator, _Columns, HasLabelCol, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable
):
    """A logistic regression as above; ``settings`` are the fields of ``Logistic`` as JSON."""

    keyCol = Param(Params._dummy(), "keyCol", "key column", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "fields of Logistic as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", probabilityCol: str = "probability",
        rawPredictionCol: str = "rawPrediction", predictionCol: str = "prediction", labelCol: str = "label",
        keyCol: str = "key", weightCol: str = "", settings: str = "{}",
    ):
        super().__init__()
        self._setDefault(keyCol="key", weightCol="", settings="{}")
        self._set(**self._input_kwargs)

    def how(self) -> Logistic:
        given = json.loads(self.getOrDefault(self.settings))
        return Logistic(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})

    def model_of(self, fitted: Fitted) -> LogisticModel:
        names = {c: self.getOrDefault(self.getParam(c)) for c in COLUMNS}
        return LogisticModel(values=fitted.coefficients.tolist(), bias=fitted.intercept, **names)

    def _fit(self, dataset: DataFrame) -> LogisticModel:
        weight = F.col(self.getWeightCol()) if self.getWeightCol() else None
        key = self.getOrDefault(self.keyCol)
        (fitted,) = fit(dataset, [self.how()], self.getLabelCol(), key, self.getFeaturesCol(), weight)
        return self.model_of(fitted)._resetUid(self.uid)


class LogisticModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Scores by built-in functions alone."""

    values = Param(Params._dummy(), "values", "coefficients", TypeConverters.toListFloat)
    bias = Param(Params._dummy(), "bias", "intercept", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, featuresCol: str | None = None, probabilityCol: str | None = None,
        rawPredictionCol: str | None = None, predictionCol: str | None = None,
        values: list[float] | None = None, bias: float | None = None,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.getOrDefault(self.values))

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.bias)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = F.array(*[F.lit(float(v)) for v in self.getOrDefault(self.values)]).cast("array<double>")
        known = vector_to_array(self.getFeaturesCol())
        terms = F.zip_with(known, weights, lambda x, w: F.nanvl(x, F.lit(0.0)) * w)
        margin = F.aggregate(terms, F.lit(float(self.intercept)), lambda total, term: total + term)
        m = F.col("__margin")
        p = 1 / (1 + F.exp(-m))
        outputs = {
            self.getRawPredictionCol(): array_to_vector(F.array(-m, m)),
            self.getProbabilityCol(): array_to_vector(F.array(1 - p, p)),
            self.getPredictionCol(): (m > 0).cast("double"),
        }
        return dataset.withColumn("__margin", margin).withColumns(outputs).drop("__margin")
