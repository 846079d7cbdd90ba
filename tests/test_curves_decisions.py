import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rarescan.operators import curves, decisions, metrics

N = 500


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(9)
    y = (rng.random(N) < 0.15).astype(int)
    s = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)  # many ties
    return pd.DataFrame({"s": s, "y": y, "g": np.arange(N) % 2})


@pytest.fixture(scope="module")
def table(spark, frame):
    return spark.createDataFrame(frame).repartition(4).cache()


def brute(frame):
    """(threshold, tp, fp) by counting, ascending thresholds."""
    out = []
    for t in np.unique(frame["s"]):
        hit = frame["s"] >= t
        out.append((t, int((hit & (frame["y"] == 1)).sum()), int((hit & (frame["y"] == 0)).sum())))
    return out


@pytest.mark.parametrize("rows_per_bucket", [250_000, 50])
def test_points_and_areas(table, frame, rows_per_bucket):
    points = curves.curve_points(table, ["s"], "y", rows_per_bucket=rows_per_bucket)
    got = [(r["threshold"], r["tp"], r["fp"]) for r in points.orderBy("threshold").collect()]
    assert got == brute(frame)
    pos, neg = frame[frame["y"] == 1]["s"].to_numpy(), frame[frame["y"] == 0]["s"].to_numpy()
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    steps, last = 0.0, 0.0
    for _, tp, fp in reversed(brute(frame)):
        steps += (tp / len(pos) - last) * tp / (tp + fp)
        last = tp / len(pos)
    area = curves.areas(points).first()
    assert area["roc_auc"] == pytest.approx(wins / len(pos) / len(neg))
    assert area["pr_auc"] == pytest.approx(steps)
    assert area["prevalence"] == pytest.approx(len(pos) / N)


def test_auc_of_the_negated_score(table):
    both = table.withColumn("t", -F.col("s"))
    got = {
        r["model"]: r["roc_auc"]
        for r in curves.areas(curves.curve_points(both, ["s", "t"], "y")).collect()
    }
    assert got["s"] + got["t"] == pytest.approx(1)


def test_groups_do_not_mix(table, frame):
    points = curves.curve_points(table, ["s"], "y", by=("g",))
    for g, part in frame.groupby("g"):
        mine = points.where(F.col("g") == g).orderBy("threshold").collect()
        assert [(r["threshold"], r["tp"], r["fp"]) for r in mine] == brute(part)


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "s double, y int")
    area = curves.areas(curves.curve_points(df, ["s"], "y")).first()
    assert area["roc_auc"] is None and area["pr_auc"] is None


@pytest.mark.parametrize("beta", [0.5, 1.0, 2.0])
def test_best_fbeta(table, frame, beta):
    best, at = -1.0, None
    total = frame["y"].sum()
    for t, tp, fp in brute(frame):
        p, r = tp / (tp + fp), tp / total
        f = (1 + beta**2) * p * r / (beta**2 * p + r + 1e-10)
        if f > best:
            best, at = f, t
    got = curves.best_fbeta(curves.curve_points(table, ["s"], "y"), beta).first()
    assert got["threshold"] == at and got["fbeta"] == pytest.approx(best)


def test_ties_go_to_the_lowest_threshold(spark):
    # at every threshold F1 is 2/3: (tp 1, fp 0, of 2) and (tp 2, fp 2, of 2)
    df = spark.createDataFrame([(0.9, 1), (0.5, 0), (0.5, 0), (0.5, 1)], "s double, y int")
    got = curves.best_fbeta(curves.curve_points(df, ["s"], "y")).first()
    assert got["threshold"] == 0.5


def test_precision_target(table, frame):
    points = curves.curve_points(table, ["s"], "y")
    total = frame["y"].sum()
    for target in (0.2, 0.5):
        reach = [(tp / total, -t) for t, tp, fp in brute(frame) if tp / (tp + fp) >= target]
        got = curves.precision_target(points, target).first()
        assert (got["recall"], got["threshold"]) == (max(reach)[0], -max(reach)[1])
    assert curves.precision_target(points, 1.1).first()["threshold"] is None
    with pytest.raises(ValueError, match="out of reach"):
        curves.require_precision(points, 1.1)


def test_curve_ends(table):
    points = curves.curve_points(table, ["s"], "y")
    last = curves.pr_curve(points).where("threshold IS NULL").collect()
    assert [(r["precision"], r["recall"]) for r in last] == [(1.0, 0.0)]
    assert curves.roc_curve(points).where("threshold IS NULL AND fpr = 0 AND tpr = 0").count() == 1


def test_metrics_and_zero_guards(spark):
    df = spark.createDataFrame([(0.5, 0), (0.2, 1), (0.7, 1), (0.1, 0)], "s double, y int")
    counts = metrics.confusion_counts(df, "y", {"mid": ("s", 0.5), "none": ("s", 2.0)})
    got = {r["name"]: r for r in metrics.binary_metrics(counts).collect()}
    mid = got["mid"]
    assert [mid[c] for c in ("tn", "fp", "fn", "tp")] == [1, 1, 1, 1]  # 0.5 counts as a hit
    assert (mid["precision"], mid["recall"], mid["f1"], mid["accuracy"]) == (0.5,) * 4
    assert got["none"]["precision"] == got["none"]["f1"] == 0
    cells = metrics.confusion_cells(counts).where("name = 'none'").collect()
    assert sum(r["n"] for r in cells) == 4 and len(cells) == 4
    report = {(r["name"], r["class"]): r for r in metrics.class_report(counts).collect()}
    assert report["none", "0"]["recall"] == 1 and report["none", "1"]["support"] == 2
    assert report["none", "weighted avg"]["precision"] == 0.25
    change = metrics.compare_thresholds(df, "y", {"s": 0.2}).first()
    assert change["recall_gain"] == 0.5


def test_tiers_are_strict(spark):
    rows = [(0.6, 1), (0.61, 1), (0.48, 0), (0.49, 0), (None, 1)]
    df = spark.createDataFrame(rows, "s double, y int")
    t = 0.6
    got = df.select(
        decisions.three_tier("s", t).alias("d"), decisions.agreement("s", t, "y").alias("a")
    ).collect()
    assert [r["d"] for r in got] == ["review", "block", "approve", "review", "error"]
    assert [r["a"] for r in got] == [0, 1, 1, 1, None]
    assert decisions.REVIEW_SHARE * t == 0.48


MEMBERS = {"lightgbm": ("a", 0.5), "xgboost": ("b", 0.5), "mlp": ("c", 0.5)}


def brute_committee(scores):
    active = {m: s for m, s in scores.items() if s is not None}
    votes = [m for m, s in active.items() if s >= 0.5]
    if not active:
        return "error"
    if len(votes) >= len(active) // 2 + 1:
        return "block"
    return "review" if votes == ["mlp"] else "approve"


def test_committee_over_all_vote_patterns(spark):
    cases = list(itertools.product((None, 0.4, 0.5), repeat=3))
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "k int, a double, b double, c double")
    got = decisions.with_committee(df, MEMBERS, details=True).orderBy("k").collect()
    for row, case in zip(got, cases):
        scores = dict(zip(MEMBERS, case))
        assert row["decision"] == brute_committee(scores), case
        assert row["active_models"] == sum(s is not None for s in case)
        assert set(row["committee"]) == {m for m, s in scores.items() if s is not None}
    assert decisions.vote_rows(df, "k", MEMBERS).count() == 54


def test_missing_members_shrink_the_committee(spark):
    df = spark.createDataFrame([(0.9,)], "c double")
    row = decisions.with_committee(df, MEMBERS).first()
    assert (row["active_models"], row["decision"]) == (1, "block")
    with pytest.raises(ValueError, match="no committee member"):
        decisions.with_committee(df.withColumnRenamed("c", "z"), MEMBERS)


def test_cost_report_arithmetic(spark):
    """The published committee run: 51,100 rows with ticket 3,500."""
    rows = [("block", 1, 277), ("approve", 0, 49482), ("approve", 1, 816), ("block", 0, 488), ("review", 0, 30), ("review", 1, 7)]
    df = spark.createDataFrame(rows, "decision string, y int, m int")
    df = df.withColumn("_", F.explode(F.sequence(F.lit(1), "m")))
    got = decisions.cost_report(df, "y").first()
    assert (got["total"], got["n_legit"], got["n_fraud"]) == (51100, 50000, 1100)
    assert round(got["hit_rate_pct"], 2) == 97.45 and round(got["friction_pct"], 2) == 0.98
    assert (got["saved"], got["lost"], got["legit_revenue"]) == (969500, 2856000, 175000000)
    empty = decisions.cost_report(df.limit(0), "y").first()
    assert empty["hit_rate_pct"] == 0 and empty["friction_pct"] == 0
