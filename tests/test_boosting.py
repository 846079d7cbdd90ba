"""Histogram boosting against a plain one in one process, and each of its parameters."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rarescan.operators import boosting
from rarescan.operators.boosting import Boost
from rarescan.plans import models, training

ROWS, FEATURES = 900, 5


def data():
    pick = np.random.default_rng(3)
    x = pick.integers(0, 9, (ROWS, FEATURES)).astype(float)
    odds = 0.5 * x[:, 0] - 0.4 * x[:, 1] * (x[:, 2] > 4) + pick.normal(size=ROWS)
    return x, (odds > 2.2).astype(int), np.arange(ROWS) % 4


@pytest.fixture(scope="module")
def table(spark):
    x, y, fold = data()
    rows = [(i, list(map(float, x[i])), int(y[i]), int(fold[i]), 1.0 + i % 3) for i in range(ROWS)]
    df = spark.createDataFrame(rows, "k int, a array<double>, y int, fold int, w double")
    return df.withColumn("features", array_to_vector("a")).repartition(3).cache()


CUTS = [np.arange(9.0)] * FEATURES


def fit(table, *hows, **more):
    return boosting.fit(table, hows, "y", "k", cuts=CUTS, **more)


class Brute:
    """The same model by recursion over rows."""

    def __init__(self, how, x, y, w):
        self.how = how
        w = w * np.array(how.class_weights)[y]
        rate = (w * y).sum() / w.sum()
        margin = np.full(len(y), math.log(rate / (1 - rate)))
        for _ in range(how.rounds):
            p = 1 / (1 + np.exp(-margin))
            g, h = w * (p - y), w * p * (1 - p)
            leaves = {"": np.arange(len(y))}
            splits = {}
            while len(leaves) < (how.num_leaves or 10**9):
                best = [(s, path) for path, rows in leaves.items() if (s := self.split(x, g, h, rows, path))]
                if not best:
                    break
                (gain, f, cut), path = max(best, key=lambda b: (b[0][0], -len(b[1])))
                rows = leaves.pop(path)
                splits[path] = (gain, rows)
                leaves[path + "L"] = rows[x[rows, f] <= cut]
                leaves[path + "R"] = rows[x[rows, f] > cut]
            while True:  # take back what gains too little
                bad = [p for p, (gain, _) in splits.items() if gain < how.min_gain and p + "L" in leaves and p + "R" in leaves]
                if not bad:
                    break
                for path in bad:
                    leaves[path] = splits.pop(path)[1]
                    del leaves[path + "L"], leaves[path + "R"]
            for rows in leaves.values():
                margin[rows] += how.value(g[rows].sum(), h[rows].sum())
            self.leaves = leaves
        self.margin = margin

    def split(self, x, g, h, rows, path):
        how, best = self.how, None
        if 0 < how.max_depth <= len(path):
            return None
        whole = how.gain(g[rows].sum(), h[rows].sum())
        for f in range(x.shape[1]):
            for cut in range(9):
                left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(len(left), len(right)) < max(how.min_child_rows, 1):
                    continue
                if min(h[left].sum(), h[right].sum()) < how.min_child_weight:
                    continue
                gain = sum(how.gain(g[s].sum(), h[s].sum()) for s in (left, right)) - whole
                if gain > boosting.LEAST_GAIN and (best is None or gain > best[0] + 1e-12):
                    best = (gain, f, cut)
        return best


def margins(model, x):
    bins = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(model.cuts)], axis=1).astype(np.uint8)
    return model.start + sum(tree.of(bins) for tree in model.trees)


CASES = [
    Boost(rounds=12, max_depth=3),
    Boost(rounds=3, max_depth=4, reg_alpha=1.5, reg_lambda=0.2, min_child_weight=4.0, learning_rate=0.5),
    Boost(rounds=3, max_depth=0, num_leaves=7, min_child_rows=25, min_child_weight=1e-3, reg_lambda=0.0),
    Boost(rounds=2, max_depth=5, min_gain=9.0, class_weights=(1.0, 5.0)),
]


@pytest.fixture(scope="module")
def together(table):
    """All cases, with and without a fold, in the same passes."""
    hows = [replace(how, without_fold=fold) for how in CASES for fold in (None, 1)]
    return hows, fit(table, *hows, weight=F.col("w"), fold="fold")


@pytest.mark.parametrize("at", range(2 * len(CASES)))
def test_shared_passes_equal_models_of_their_own(together, at):
    hows, fitted = together
    x, y, fold = data()
    w = 1.0 + np.arange(ROWS) % 3
    inside = fold != (-1 if hows[at].without_fold is None else hows[at].without_fold)
    brute = Brute(hows[at], x[inside], y[inside], w[inside])
    assert margins(fitted[at], x[inside]) == pytest.approx(brute.margin, abs=1e-9)
    leaves = (fitted[at].trees[-1].feature < 0).sum()
    assert leaves == len(brute.leaves) <= (hows[at].num_leaves or 99)


def test_leaf_wise_trees_are_deeper_and_bounded(table):
    (model,) = fit(table, Boost(rounds=1, max_depth=-1, num_leaves=31, min_child_weight=0.01, min_child_rows=1))
    nodes = model.nodes()
    assert 2 < (nodes["feature"] < 0).sum() <= 31
    depth = {0: 0}
    for n in nodes.to_dict("records"):
        for child in (n["left"], n["right"]):
            if n["feature"] >= 0:
                depth[child] = depth[n["node"]] + 1
    leaves = [depth[n] for n in nodes.loc[nodes["feature"] < 0, "node"]]
    assert max(leaves) > 5 > min(leaves)  # a full tree of 31 leaves has five levels


@pytest.mark.parametrize(
    "change",
    [
        {"learning_rate": 0.3}, {"max_depth": 2}, {"min_child_weight": 30.0}, {"min_gain": 20.0}, {"rounds": 3},
        {"reg_alpha": 5.0}, {"reg_lambda": 50.0}, {"subsample": 0.5}, {"colsample": 0.4},
    ],
    ids=str,
)
def test_each_parameter_acts(table, every, change):
    x, _, _ = data()
    plain, changed = every[0], every[1][str(change)]
    assert np.abs(margins(plain, x) - margins(changed, x)).max() > 1e-3
    if "reg_alpha" in change or "reg_lambda" in change:
        assert np.abs(changed.trees[0].value).max() < np.abs(plain.trees[0].value).max()
    if "colsample" in change:
        for number, tree in enumerate(changed.trees):
            assert set(tree.feature[tree.feature >= 0]) <= set(changed.how.columns(FEATURES, number))


@pytest.fixture(scope="module")
def every(table):
    base = Boost(rounds=2, max_depth=4)
    changes = [
        {"learning_rate": 0.3}, {"max_depth": 2}, {"min_child_weight": 30.0}, {"min_gain": 20.0}, {"rounds": 3},
        {"reg_alpha": 5.0}, {"reg_lambda": 50.0}, {"subsample": 0.5}, {"colsample": 0.4},
    ]
    plain, *rest = fit(table, base, *(replace(base, **c) for c in changes))
    return plain, {str(c): m for c, m in zip(changes, rest)}


def test_samples_follow_the_key_and_the_tree():
    hashes = np.random.default_rng(0).integers(0, 1 << 62, 20_000).astype(np.uint64)
    how = Boost(subsample=0.7)
    one, two = how.sampled(hashes, 1), how.sampled(hashes, 2)
    assert one.mean() == pytest.approx(0.7, abs=0.02) and (one == how.sampled(hashes, 1)).all()
    assert (one & two).mean() == pytest.approx(0.49, abs=0.02)


def test_stage_scores_saves_and_explains(spark, table, tmp_path):
    x, y, _ = data()
    spec = models.MODELS["xgb"]
    ctx = models.FitContext("y", "k", float(ROWS), FEATURES, "w")
    stage = spec.build({**spec.defaults, "n_estimators": 11, "colsample": 1.0}, ctx)
    model = stage.fit(table)
    out = model.transform(table)
    assert training.exact_auc(out.select("y", training.score_column("xgb", out.columns).alias("score")), "y") > 0.8
    model.write().save(str(tmp_path / "model"))
    again = boosting.HistogramBoosterModel.load(str(tmp_path / "model")).transform(table)
    column = "xgb__probability"
    assert again.select(column).collect() == out.select(column).collect()
    shares = model.featureImportances.toArray()
    assert shares.sum() == pytest.approx(1) and shares[0] == max(shares)


def test_odd_rows_do_not_break_a_fit(spark):
    rows = [(i, [None if i % 5 == 0 else float(i % 7), float("nan")], None if i == 3 else i % 2, 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, a array<double>, y int, n double")
    df = df.withColumn("a", F.transform("a", lambda v: F.coalesce(v, F.lit(float("nan")))))
    df = df.withColumn("features", array_to_vector("a"))
    (model,) = boosting.fit(df, [Boost(rounds=2, max_depth=2, min_child_weight=0.1)], "y", "k")
    assert len(model.trees) == 2
    (flat,) = boosting.fit(df.where("y = 1"), [Boost(rounds=1)], "y", "k")
    assert len(flat.trees[0].feature) == 1 and flat.start > 10


def test_passes_give_the_models_that_tasks_fit_alone(table, together, monkeypatch):
    hows, alone = together
    monkeypatch.setattr(boosting, "LOCAL_BYTES", 0)
    x, _, _ = data()
    for few in (hows[:4], hows):  # large codes, small codes
        passed = fit(table, *few, weight=F.col("w"), fold="fold")
        for one, other in zip(passed, alone):
            assert one.areas is None and other.areas is not None
            assert margins(one, x) == pytest.approx(margins(other, x), abs=1e-9)


def test_codes_hold_the_bins_of_several_features():
    sizes = [65, 3, 65, 3, 40, 10, 1]
    pick = np.random.default_rng(1)
    bins = np.stack([pick.integers(0, size, 500) for size in sizes]).astype(np.uint8)
    g, place = pick.normal(size=500), pick.integers(0, 4, 500)
    for most in (boosting.PACKED, boosting.PACKED_LOCAL):
        packing = boosting.Packing(sizes, most)
        assert len(packing.groups) < len(sizes) and max(packing.values) <= most
        codes, sums = packing.packed(bins), np.zeros((2, 4, sum(sizes)))
        packing.add(sums, codes, place, (g, None), range(len(sizes)))
        for feature, size in enumerate(sizes):
            at, table = packing.goes_left(feature, 1)
            assert (table[codes[at]] == (bins[feature] <= 1)).all()
            for part in range(4):
                own = bins[feature][place == part]
                found = sums[:, part, packing.offsets[feature] :][:, :size]
                assert found[0] == pytest.approx(np.bincount(own, g[place == part], size))
                assert (found[1] == np.bincount(own, minlength=size)).all()


def test_cuts_are_quantiles_of_all_rows(spark, monkeypatch):
    rows = spark.range(200_000, numPartitions=4).selectExpr(
        "array((id * 7919) % 200000 / 10D, id % 3, if(id = 77, -5D, if(id % 2 = 0, double('nan'), 4D))) a"
    )
    cuts = boosting.feature_cuts(rows.select(array_to_vector("a").alias("features")), "features")
    exact = np.arange(64) / 64 * 20_000
    assert cuts[0] == pytest.approx(exact, abs=20_000 * 0.002) and cuts[0][0] == 0
    assert cuts[1].tolist() == [0, 1, 2] and cuts[2].tolist() == [-5, 4]


def test_search_takes_the_areas_of_the_fit(spark, table, monkeypatch):
    from rarescan.config import SETTINGS, Roles

    spec = replace(models.MODELS["xgb"], draws=2)
    monkeypatch.setattr(training, "preprocessor", lambda *_: type("P", (), {"fit": lambda s, d: s, "transform": lambda s, d: d})())
    monkeypatch.setattr(training, "_width", lambda _: FEATURES)
    roles = Roles(key="k", label="y", numeric=(), categorical=())
    tried = [{**c, "n_estimators": 5} for c in spec.candidates(1)]
    small = training.shared_scores(table, spec, tried, roles, SETTINGS)
    monkeypatch.setattr(boosting, "LOCAL_BYTES", 0)
    judged = training.shared_scores(table, spec, tried, roles, SETTINGS)
    assert np.array(small) == pytest.approx(np.array(judged), abs=1e-9)
