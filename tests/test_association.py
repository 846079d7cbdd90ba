import math
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rarescan.operators import association

N = 600


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(5)
    y = (rng.random(N) < 0.2).astype(int)
    return pd.DataFrame(
        {
            "k": np.arange(N),
            "signal": rng.normal(size=N) + y,
            "tied": rng.integers(0, 5, N).astype(float) + y,
            "noise": rng.normal(size=N),
            "same": np.full(N, 3.0),
            "y": y,
        }
    )


@pytest.fixture(scope="module")
def table(spark, frame):
    return spark.createDataFrame(frame).repartition(5).cache()


FEATURES = ["signal", "tied", "noise", "same"]


@pytest.mark.parametrize("lookup", [association.LOOKUP_VALUES, 10, 0])
@pytest.mark.parametrize("rows_per_bucket", [250_000, 50])
def test_spearman(table, frame, monkeypatch, lookup, rows_per_bucket):
    monkeypatch.setattr(association, "LOOKUP_VALUES", lookup)
    monkeypatch.setattr(association, "HOT_SHARE", 20)
    columns = [*FEATURES, "y"]
    matrix = association.spearman(table, "k", columns, rows_per_bucket=rows_per_bucket)
    got = {(r["col1"], r["col2"]): r["rho"] for r in matrix.collect()}
    want = frame[columns].rank().corr()
    for a in columns:
        for b in columns:
            if "same" in (a, b):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-12)
    ranking = association.target_correlation(matrix, "y").collect()
    assert [r["feature"] for r in ranking][-1] == "same" and len(ranking) == 4


def test_ranks_are_read_once(spark, monkeypatch):
    """The joins behind the ranks run a single time; a constant column is null, an empty table all null."""
    read = spark.sparkContext.accumulator(0)
    rng = np.random.default_rng(8)
    x = rng.permutation(200) - 99.5
    rows = [(float(a), float(-a), 0.0, float(b)) for a, b in zip(x, rng.permutation(x))]

    def ranked(df, key, columns):
        @F.udf("double")
        def seen(v):
            read.add(1)
            return v

        frame = spark.createDataFrame(rows, ["a", "b", "c", "d"]).repartition(3)
        return frame.withColumn("a", seen("a"))

    monkeypatch.setattr(association, "_ranked", ranked)
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0), (2.0, 1.0, 3.0, 5.0)], ["a", "b", "c", "d"])
    got = association._complete_spearman(df, "k", ["a", "b", "c", "d"])
    assert read.value == 200
    assert got["a", "b"] == pytest.approx(-1, abs=1e-12) and got["a", "a"] == 1
    assert got["a", "d"] == pytest.approx(np.corrcoef([r[0] for r in rows], [r[3] for r in rows])[0, 1], abs=1e-12)
    assert all(got[pair] is None for pair in got if "c" in pair)
    rows.clear()
    monkeypatch.setattr(association, "_ranked", lambda df, key, columns: df)
    assert set(association._complete_spearman(df.where("a > 5"), "k", ["a", "b"]).values()) == {None}


def brute_u(x, y):
    pos, neg = x[y == 1], x[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    n1, n2, n = len(pos), len(neg), len(x)
    _, t = np.unique(x, return_counts=True)
    s = math.sqrt(n1 * n2 / 12 * ((n + 1) - (t**3 - t).sum() / (n * (n - 1))))
    if s == 0:
        return wins, 1.0
    z = (max(wins, n1 * n2 - wins) - n1 * n2 / 2 - 0.5) / s
    return wins, min(1.0, math.erfc(z / math.sqrt(2)))


@pytest.mark.parametrize("rows_per_bucket", [250_000, 50])
def test_mann_whitney(table, frame, rows_per_bucket):
    tests = association.mann_whitney(table, FEATURES, "y", rows_per_bucket=rows_per_bucket)
    got = {r["feature"]: r for r in tests.collect()}
    for c in FEATURES:
        u, p = brute_u(frame[c].to_numpy(), frame["y"].to_numpy())
        assert got[c]["u_stat"] == u
        assert got[c]["p_value"] == pytest.approx(p, rel=1e-9)
        assert (got[c]["conclusion"] == "significant") == (p < 0.05)
    # swapping the classes gives the other U
    swapped = table.withColumn("y", 1 - F.col("y"))
    other = {r["feature"]: r for r in association.mann_whitney(swapped, FEATURES, "y").collect()}
    for c in FEATURES:
        assert got[c]["u_stat"] + other[c]["u_stat"] == got[c]["n1"] * got[c]["n2"]


def test_sample_for_the_test_only_where_asked(table):
    assert association.mann_whitney_sample(table, "k", "y", "s") is table
    few = association.mann_whitney_sample(table, "k", "y", "s", per_class=7)
    assert {r["y"]: r["count"] for r in few.groupBy("y").count().collect()} == {0: 7, 1: 7}


def test_mi_binned(table, frame):
    got = {r["feature"]: r for r in association.mi_binned(table, FEATURES, "y").collect()}
    for c in FEATURES:
        edges = np.unique(frame[c].quantile([i / 10 for i in range(1, 10)]))
        bins = (frame[c].to_numpy()[:, None] > edges[None, :]).sum(axis=1)
        joint = pd.crosstab(bins, frame["y"]).to_numpy() / N
        outer = joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)
        seen = joint > 0
        mi = (joint[seen] * np.log(joint[seen] / outer[seen])).sum()
        assert got[c]["mi"] == pytest.approx(mi, abs=1e-12)


def brute_neighbor_mi(x, y, k=3):
    """Straight from the definition, all distances at once; x are whole numbers."""

    def digamma(n):
        return sum(1.0 / i for i in range(1, int(n))) - np.euler_gamma

    distance = np.abs(x[:, None] - x[None, :])
    used = np.array([np.sum(y == c) > 1 for c in y])
    total = []
    for i in np.flatnonzero(used):
        own = np.flatnonzero(y == y[i])
        near = min(k, len(own) - 1)
        reach = max(1, np.sort(distance[i, own])[near]) - 1
        m = (distance[i] <= reach)[used].sum()
        total.append((digamma(near), digamma(len(own)), digamma(m)))
    a = np.array(total)
    return max(0.0, digamma(used.sum()) + a[:, 0].mean() - a[:, 1].mean() - a[:, 2].mean())


def test_mi_knn_against_brute_force(spark, table):
    got = {r["feature"]: r["mi"] for r in association.mi_knn(table, "k", FEATURES, "y", "s").collect()}
    assert set(got) == set(FEATURES)
    cells = association._grid(table, "k", FEATURES, "y", "s").toPandas()
    for c, rows in cells.groupby("feature"):
        expected = brute_neighbor_mi(rows["v"].to_numpy(), rows["y"].to_numpy())
        assert got[c] == pytest.approx(expected, abs=1e-9), c
    assert got["signal"] > got["noise"] and got["tied"] > 0.01 and got["same"] < 0.01
    few = spark.createDataFrame(
        [(1, 0.0, 0), (2, 1.0, 0), (3, 2.5, 0), (4, 9.0, 1), (5, None, 2), (6, 0.5, 2)], "k int, x double, y int"
    )
    used = few.where("y <> 1")  # a class of one row has no neighbours
    cells = association._grid(used, "k", ["x"], "y", "s").toPandas()
    got = association.mi_knn(few, "k", ["x"], "y", "s").first()["mi"]
    assert got == pytest.approx(brute_neighbor_mi(cells["v"].to_numpy(), cells["y"].to_numpy()), abs=1e-9)


def test_spearman_leaves_nulls_out_pair_by_pair(spark):
    rng = np.random.default_rng(8)
    frame = pd.DataFrame({c: np.round(rng.normal(size=300), 1) for c in "abcd"})
    frame.loc[::7, "b"] = None
    frame.loc[::5, "c"] = None
    frame["k"] = range(300)
    frame["e"] = 1.0
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, k int, e double")
    matrix = association.spearman(df, "k", list("abcde")).collect()
    expected = frame[list("abcde")].corr(method="spearman")
    assert len(matrix) == 25
    for r in matrix:
        rho = expected.loc[r["col1"], r["col2"]]
        assert r["rho"] is None if np.isnan(rho) else r["rho"] == pytest.approx(rho, abs=1e-12)


def test_screening(spark):
    described = spark.createDataFrame([("a", 0.0), ("b", 1.0), ("c", 1.0), ("d", 1.0)], "feature string, std double")
    outliers = spark.createDataFrame([("a", 0.0), ("b", 20.0), ("c", 15.0), ("d", 30.0)], "feature string, outlier_pct double")
    mi = spark.createDataFrame([("a", 0.0), ("b", 0.1), ("c", 0.1), ("d", 0.0)], "feature string, mi_adjusted double")
    tests = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", 0.0), ("d", 0.4)], "feature string, p_value double")
    got = association.screen_features(described, outliers, mi, tests).collect()
    assert [(r["feature"], r["action"], r["reason"]) for r in got] == [
        ("a", "drop", "constant"),
        ("b", "clip", "many outliers"),
        ("c", "keep", ""),
        ("d", "drop", "no signal"),
    ]


def test_exact_mann_whitney_against_enumeration():
    from itertools import combinations
    from math import comb

    for n1, n2 in ((1, 1), (1, 9), (3, 4), (5, 3), (4, 8)):
        m, n = min(n1, n2), n1 + n2
        found = [sum(c) - m * (m + 1) // 2 for c in combinations(range(1, n + 1), m)]
        for u in range(n1 * n2 + 1):
            far = max(u, n1 * n2 - u)
            want = min(1.0, 2 * sum(x >= far for x in found) / comb(n, m))
            assert association.exact_p(n1, n2, u) == pytest.approx(want, rel=1e-12), (n1, n2, u)
    assert association.exact_p(0, 5, 0) == 1.0
    # as many rows as one likes on the other side: near the normal form
    n2 = 10**9
    u = int(8 * n2 / 2 + 1.5 * (8 * n2 * (n2 + 9) / 12) ** 0.5)
    assert association.exact_p(8, n2, u) == pytest.approx(0.1336, abs=0.01)


def test_mann_whitney_is_exact_for_few_untied_rows(spark):
    rows = [("a", 1, 9.0), ("a", 1, 8.0), *(("a", 0, float(v)) for v in range(6))]
    rows += [("b", 1, 1.0), ("b", 1, 2.0), ("b", 0, 1.0), ("b", 0, 0.0), ("c", 0, 1.0), ("c", 0, 2.0)]
    df = spark.createDataFrame(rows, "g string, y int, x double")
    got = {r.g: r for r in association.mann_whitney(df, ["x"], "y", by=["g"]).collect()}
    assert got["a"].u_stat == 12 and got["a"].p_value == pytest.approx(2 / 28)
    assert got["b"].p_value == pytest.approx(0.4142, abs=1e-3) and got["c"].p_value == 1.0


def test_mi_knn_over_many_blocks(spark):
    rng = np.random.default_rng(21)
    n = 900
    y = np.where(rng.random(n) < 0.04, 1, np.where(rng.random(n) < 0.5, 2, 0))
    gap = np.where(rng.random(n) < 0.5, 0.0, 1000.0) + rng.normal(size=n)
    rows = [(i, int(c), float(g), float(i % 2), float(v)) for i, (c, g, v) in enumerate(zip(y, gap, y + rng.normal(size=n)))]
    df = spark.createDataFrame(rows, "k int, y int, gap double, two double, signal double")
    names = ["gap", "two", "signal"]
    got = {r["feature"]: r["mi"] for r in association.mi_knn(df, "k", names, "y", "s", rows_per_bucket=11).collect()}
    one = {r["feature"]: r["mi"] for r in association.mi_knn(df, "k", names, "y", "s").collect()}
    cells = association._grid(df, "k", names, "y", "s").toPandas()
    for c, own in cells.groupby("feature"):
        expected = brute_neighbor_mi(own["v"].to_numpy(), own["y"].to_numpy())
        assert got[c] == pytest.approx(expected, abs=1e-9) == one[c], c


def test_mi_knn_rows_of_one_key_and_class_are_one_term(spark):
    rng = np.random.default_rng(22)
    rows = [(None if i % 50 == 0 else i // 2, int(i % 6 < 2), float(rng.normal())) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, y int, x double")
    cells = association._grid(df, "k", ["x"], "y", "s").toPandas()
    v, y = cells["v"].to_numpy(), cells["y"].to_numpy()
    distance, terms = np.abs(v[:, None] - v[None, :]), {}
    for i, key in enumerate(cells["key"].astype(object).where(cells["key"].notna(), None)):
        reach = max(1, np.sort(distance[i, y == y[i]])[3]) - 1
        terms[key, y[i]] = terms.get((key, y[i]), 0) + (distance[i] <= reach).sum()
    digamma = lambda n: sum(1.0 / i for i in range(1, int(n))) - np.euler_gamma
    values = [digamma(3) - digamma((y == c).sum()) - digamma(n) for (_, c), n in terms.items()]
    for size in (7, 1000):
        got = association.mi_knn(df, "k", ["x"], "y", "s", rows_per_bucket=size).first()["mi"]
        assert got == pytest.approx(max(0.0, digamma(len(terms)) + np.mean(values)), abs=1e-9)


def test_mi_knn_writes_few_bytes_a_cell(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    size = lambda: sum(f.stat().st_size for f in shared.rglob("*.parquet"))
    df = spark.range(20_000).select("id", *[F.rand(i).alias(f"c{i}") for i in range(5)], (F.col("id") % 50 == 0).cast("int").alias("y"))
    before = size()
    association.mi_knn(df, "id", [f"c{i}" for i in range(5)], "y", "s").collect()
    assert size() - before < 2 * 100_000  # of 100,000 cells
