"""Forests against plain trees in one process, and as MLlib's models."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rarescan.operators import forest
from rarescan.operators.forest import Forest, ForestClassifier
from rarescan.plans import models, training

ROWS, FEATURES = 700, 5


def data():
    pick = np.random.default_rng(5)
    x = pick.integers(0, 7, (ROWS, FEATURES)).astype(float)
    odds = 0.6 * x[:, 0] - 0.5 * x[:, 1] * (x[:, 2] > 3) + pick.normal(size=ROWS)
    return x, (odds > 1.5).astype(int)


@pytest.fixture(scope="module")
def table(spark):
    x, y = data()
    rows = [(i, list(map(float, x[i])), int(y[i]), 1.0 + 2 * int(y[i]), 1.0 + i % 3) for i in range(ROWS)]
    df = spark.createDataFrame(rows, "k bigint, a array<double>, y int, w double, u double")
    return df.withColumn("features", array_to_vector("a")).repartition(3).cache()


def brute(how, x, y, w, times, cuts, tree):
    """Rows and weights of the nodes of a tree, by level, as it grows without pruning."""
    gini = lambda r: 1 - sum(((w * times)[r][y[r] == c].sum() / max((w * times)[r].sum(), 1e-300)) ** 2 for c in (0, 1))
    nodes, todo, out = 1, [(0, np.flatnonzero(times), 0)], {}
    while todo:
        node, rows, level = todo.pop(0)
        out[node] = (times[rows].sum(), (w * times)[rows][y[rows] == 1].sum())
        best = None
        for f in how.subset(FEATURES, tree, node) if level < how.max_depth and gini(rows) > 1e-12 else ():
            for cut in cuts[f]:
                left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(times[left].sum(), times[right].sum()) < max(1, how.min_rows):
                    continue
                weigh = lambda r: (w * times)[r].sum() / (w * times)[rows].sum()
                gain = gini(rows) - weigh(left) * gini(left) - weigh(right) * gini(right)
                if gain > 0 and (best is None or gain > best[0] + 1e-12):
                    best = gain, left, right
        if best:
            todo += [(nodes, best[1], level + 1), (nodes + 1, best[2], level + 1)]
            nodes += 2
    return out


@pytest.mark.parametrize("weight", ["w", "u"])  # even within a class, and not
@pytest.mark.parametrize("small", [False, True])
def test_trees_are_those_of_a_plain_loop(spark, table, monkeypatch, weight, small):
    if small:  # many passes a level, blocks that are read again
        monkeypatch.setattr(forest, "SUM_BYTES", 4_000)
        monkeypatch.setattr(forest, "KEPT_BYTES", 0)
    how = Forest(trees=3, max_depth=4, min_rows=5, max_features="0.6", seed=9)
    trees, cuts = forest.fit(table, how, "y", "k", weight=F.col(weight))
    ordered = table.orderBy("k").select("a", "y", weight, F.xxhash64("k").alias("h")).collect()
    x, y, w = (np.array([r[i] for r in ordered]) for i in range(3))
    hashes = np.array([r["h"] for r in ordered], np.int64).view(np.uint64)
    for number, tree in enumerate(trees):
        times = how.drawn(hashes, number).astype(float)
        expected = brute(how, x, y, w, times, cuts, number)
        assert len(tree.feature) == len(expected) > 7
        found = sorted((float(r.sum()), float(v[1])) for r, v in zip(tree.rows, tree.weights))
        assert np.array(found) == pytest.approx(np.array(sorted(expected.values())), abs=1e-6)


def test_draws_are_poisson_and_differ_by_tree():
    hashes = np.random.default_rng(0).integers(0, 1 << 62, 50_000).astype(np.uint64) * np.uint64(4)
    how = Forest(trees=10)
    one, two = how.drawn(hashes, 1), how.drawn(hashes, 2)
    shares = np.bincount(one, minlength=4)[:4] / len(one)
    assert shares == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613], abs=0.01)
    assert abs(np.corrcoef(one, two)[0, 1]) < 0.02


def test_features_tried():
    tried = {"sqrt": 8, "log2": 6, "0.3": 20, "0.5": 32, "all": 64, "5": 5}
    assert {name: Forest(max_features=name).tried(64) for name in tried} == tried


def test_stage_is_a_model_of_mllib(table, tmp_path):
    spec = models.MODELS["rf"]
    ctx = models.FitContext("y", "k", float(ROWS), FEATURES, "w")
    stage = spec.build({**spec.defaults, "n_estimators": 20, "min_samples_leaf": 2}, ctx)
    assert isinstance(stage, ForestClassifier)
    model = stage.fit(table)
    assert isinstance(model, RandomForestClassificationModel) and model.getNumTrees == 20
    out = model.transform(table)
    assert training.exact_auc(out.select("y", training.score_column("rf", out.columns).alias("score")), "y") > 0.9
    shares = model.featureImportances.toArray()
    assert shares.sum() == pytest.approx(1) and shares[0] == max(shares)
    model.write().save(str(tmp_path / "rf"))
    again = RandomForestClassificationModel.load(str(tmp_path / "rf")).transform(table)
    assert again.select("k", "rf__probability").collect() == out.select("k", "rf__probability").collect()


def test_odd_tables(spark):
    df = spark.createDataFrame([(i, [float("nan"), float(i % 2)], 1) for i in range(9)], "k int, a array<double>, y int")
    df = df.withColumn("features", array_to_vector("a"))
    model = ForestClassifier(labelCol="y", keyCol="k", settings='{"trees": 2}').fit(df)
    assert model.totalNumNodes == 2 and {r[0] for r in model.transform(df).select("prediction").collect()} == {1.0}
    with pytest.raises(ValueError, match="rows"):
        ForestClassifier(labelCol="y", keyCol="k").fit(df.where("k < 0"))


def test_leaves_have_no_negative_weights(spark):
    """Weights such as 0.1 do not cancel exactly when a child has its parent's rest."""
    rows = [(i, [float(i % 97), float(i % 89)], int(i % 97 > 60), 0.1 + 0.2 * (i % 97 > 60)) for i in range(900)]
    df = spark.createDataFrame(rows, "k bigint, a array<double>, y int, w double").withColumn("features", array_to_vector("a"))
    trees, _ = forest.fit(df, Forest(trees=30, max_depth=8), "y", "k", weight=F.col("w"))
    for tree in trees:
        for counted, weights in zip(tree.rows, tree.weights):
            assert (weights >= 0).all() and (weights[counted == 0] == 0).all()
