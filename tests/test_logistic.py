"""Penalised logistic regression against plain solvers, paths, weights, folds and saving."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rarescan.operators import logistic
from rarescan.operators.logistic import Logistic, LogisticModel, PenalisedLogistic

GRID = [Logistic(C=c, penalty=p) for p in ("l1", "l2") for c in (0.001, 0.01, 0.1, 1, 10)]


def _sample(n=400, seed=5):
    random = np.random.default_rng(seed)
    x = np.round(random.normal(size=(n, 5)), 3)
    x[:, 3] = x[:, 0] + 0.1 * x[:, 3]  # nearly the same column twice
    x[:, 4] = 0
    y = (x[:, 0] - 0.7 * x[:, 1] + random.logistic(size=n) > 1).astype(float)
    return x, y, np.round(random.uniform(0.5, 3, n), 2)


def plain(how, x, y, w):
    """Accelerated proximal gradient steps until nothing moves; the intercept is a column."""
    x = np.hstack([x, np.ones((len(x), 1))])
    rate = 1 / (how.C * np.linalg.norm(x * np.sqrt(w / 4)[:, None], 2) ** 2 + (how.penalty == "l2"))
    b = ahead = np.zeros(x.shape[1])
    t = 1.0
    for _ in range(200_000):
        slope = how.C * (x.T @ (w * (1 / (1 + np.exp(-x @ ahead)) - y)))
        if how.penalty == "l2":
            new = ahead - rate * (slope + ahead)
        else:
            new = ahead - rate * slope
            new = np.sign(new) * np.maximum(np.abs(new) - rate, 0)
        if (ahead - new) @ (new - b) > 0:  # going back: start again without speed
            t = 1.0
        speed = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, moved = new + (t - 1) / speed * (new - b), np.abs(new - b).max()
        b, t = new, speed
        if moved < 1e-14:
            break
    return b


@pytest.fixture(scope="module")
def rows(spark):
    x, y, w = _sample()
    data = [
        (i, float(t), float(u), i % 3, [float(v) for v in r]) for i, (r, t, u) in enumerate(zip(x, y, w))
    ]
    df = spark.createDataFrame(data, "k long, y double, w double, fold int, v array<double>")
    return df.withColumn("features", array_to_vector("v")).drop("v").repartition(3).cache()


def _values(fitted):
    return np.append(fitted.coefficients, fitted.intercept)


def test_grid_matches_plain_solver(rows):
    x, y, w = _sample()
    for how, found in zip(GRID, logistic.fit(rows, GRID, "y", "k", weight=F.col("w"))):
        assert np.allclose(_values(found), plain(how, x, y, w), atol=1e-6), how
        assert found.coefficients[4] == 0


def test_penalty_acts_on_the_intercept_and_l1_leaves_columns_out(rows):
    found = {(h.penalty, h.C): f for h, f in zip(GRID, logistic.fit(rows, GRID, "y", "k"))}
    assert np.all(_values(found["l1", 0.001]) == 0)
    assert np.sum(found["l1", 0.1].coefficients != 0) < np.sum(found["l2", 0.1].coefficients != 0)
    assert abs(found["l2", 0.001].intercept) < abs(found["l2", 10].intercept)


def test_folds_weights_and_paths_share_passes(rows):
    hows = [Logistic(C=c, without_fold=f, class_weights=(1.0, 4.0)) for c in (0.1, 1.0) for f in (0, 1, None)]
    found = logistic.fit(rows, hows, "y", "k", weight=F.col("w"), fold="fold")
    for how, shared in zip(hows, found):
        part = rows if how.without_fold is None else rows.where(F.col("fold") != how.without_fold)
        part = part.withColumn("w", F.col("w") * F.when(F.col("y") > 0, 4.0).otherwise(1.0))
        (alone,) = logistic.fit(part, [Logistic(C=how.C)], "y", "k", weight=F.col("w"))
        assert np.allclose(_values(shared), _values(alone), atol=1e-7)
    assert max(f.steps for f in found) <= 20


def test_steps_that_overshoot_are_halved(spark):
    """A column of very unlike sizes: whole Newton steps from 0 would pass the minimum."""
    random = np.random.default_rng(2)
    x = np.concatenate([random.normal(size=60), [400.0, -500.0, 300.0]])[:, None]
    y = (x[:, 0] > 0).astype(float)
    y[-3:] = [0, 1, 0]
    data = [(i, float(t), [float(v[0])]) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "k long, y double, v array<double>").withColumn("features", array_to_vector("v"))
    for how in (Logistic(C=10.0), Logistic(C=10.0, penalty="l1")):
        (found,) = logistic.fit(df, [how], "y", "k")
        assert np.allclose(_values(found), plain(how, x, y, np.ones(len(x))), atol=1e-6)


def test_defined_cases(spark, rows):
    (none,) = logistic.fit(rows.where("false"), [Logistic()], "y", "k")
    assert none.intercept == 0
    odd = spark.createDataFrame([(1, None, [float("nan"), 1.0]), (2, 1.0, [2.0, 0.0])], "k long, y double, v array<double>")
    (found,) = logistic.fit(odd.withColumn("features", array_to_vector("v")), [Logistic(C=1.0)], "y", "k")
    x, y = np.array([[0.0, 1.0], [2.0, 0.0]]), np.array([0.0, 1.0])
    assert np.allclose(_values(found), plain(Logistic(C=1.0), x, y, np.ones(2)), atol=1e-6)
    (stopped,) = logistic.fit(rows, [Logistic(max_iter=1)], "y", "k")
    assert np.all(_values(stopped) == 0)
    for wrong in ({"penalty": "l3"}, {"C": 0}):
        with pytest.raises(ValueError):
            Logistic(**wrong)


def test_estimator_scores_and_saves(rows, tmp_path):
    estimator = PenalisedLogistic(labelCol="y", keyCol="k", weightCol="w", settings='{"C": 1, "penalty": "l1"}')
    model = estimator.fit(rows)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = LogisticModel.load(str(tmp_path / "m"))
    x, _, _ = _sample()
    margin = x @ model.coefficients.toArray() + model.intercept
    for one in (model, again):
        got = one.transform(rows).orderBy("k").collect()
        assert np.allclose([r["rawPrediction"][1] for r in got], margin)
        assert np.allclose([r["probability"][1] for r in got], 1 / (1 + np.exp(-margin)))
        assert [r["prediction"] for r in got] == (margin > 0).astype(float).tolist()


def test_l1_step_without_sweeps_where_columns_repeat(monkeypatch):
    monkeypatch.setattr(logistic, "SWEEPS", 0)
    random = np.random.default_rng(2)
    x = random.normal(size=(500, 30))
    x[:, 20:] = x[:, :10]  # the same columns twice
    x[:, 15] = 0
    how, start = Logistic(C=10.0, penalty="l1"), np.zeros(30)
    start[[0, 20, 4]] = 0.3, -0.1, 2.0
    slope, gram = x.T @ random.normal(size=500), x.T @ x
    end = start + logistic.newton_step(how, start, slope, gram)
    pull = how.C * (slope + gram @ (end - start))
    used = end != 0
    assert used.any() and np.allclose(pull[used], -np.sign(end[used]), atol=1e-6) and np.all(np.abs(pull) <= 1 + 1e-6)
