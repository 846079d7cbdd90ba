import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rarescan.operators import ranks
from rarescan.operators.quantiles import exact_quantiles, rank_values

N = 4000
PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(1)
    hot = rng.normal(size=N)
    hot[: N // 3] = 0.25  # a third of the rows hold one value
    holes = rng.integers(0, 50, N).astype(float)
    holes[rng.random(N) < 0.3] = np.nan
    return pd.DataFrame(
        {
            "k": np.arange(N),
            "spread": rng.normal(size=N) * 1e6,
            "hot": rng.permutation(hot),
            "two": (rng.random(N) < 0.5).astype(float),
            "holes": holes,
            "same": np.full(N, 7.0),
            "signed": np.where(rng.random(N) < 0.5, 0.0, -0.0),
            "y": (rng.random(N) < 0.1).astype(int),
        }
    )


@pytest.fixture(scope="module")
def table(spark, frame):
    df = spark.createDataFrame(frame).repartition(6)
    return df.withColumns({"holes": F.nanvl("holes", F.lit(None).cast("double"))}).cache()


COLUMNS = ["spread", "hot", "two", "holes", "same", "signed"]


def want(frame, probs):
    return {c: frame[c].dropna().quantile(probs).tolist() for c in COLUMNS}


@pytest.mark.parametrize(
    "limits",
    [
        {},  # plain aggregate
        {"small_cells": 0},  # counted, then collected
        {"small_cells": 0, "small": 40, "accuracy": 50},  # several rounds of narrowing
        {"small_cells": 0, "small": 0, "accuracy": 1000},
    ],
)
def test_quantiles_match_pandas(table, frame, limits):
    got = exact_quantiles(table, COLUMNS, PROBS, **limits)
    for c, q in want(frame, PROBS).items():
        assert got[c] == pytest.approx(q, rel=1e-12, abs=1e-12), c


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert exact_quantiles(empty, ["a", "b"], [0.5]) == {"a": [None], "b": [None]}
    blank = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert exact_quantiles(blank, ["a", "b"], [0.5], small_cells=0) == {"a": [None], "b": [1.0]}


def test_rank_values(table, frame):
    ordered = np.sort(frame["hot"].to_numpy())
    targets = [(r, F.col("hot"), r, N) for r in (0, 5, 1000, 2000, N - 1)]
    got = rank_values(table, targets, small=20, accuracy=40)
    assert got == {r: ordered[r] for r in (0, 5, 1000, 2000, N - 1)}


@pytest.mark.parametrize("rows_per_bucket", [250_000, 100])
def test_running_counts(table, frame, rows_per_bucket):
    got = ranks.running_counts(
        table, COLUMNS, "y", rows_per_bucket=rows_per_bucket
    ).toPandas()
    assert not got.duplicated(["feature", "value"]).any()
    for c in COLUMNS:
        known = frame.dropna(subset=[c])
        part = got[got["feature"] == c].sort_values("value")
        sizes = known.groupby(known[c] + 0.0)["y"].agg(["count", "sum"])
        assert part["value"].tolist() == sizes.index.tolist()
        assert part["n"].tolist() == sizes["count"].tolist()
        assert part["n_below"].tolist() == (sizes["count"].cumsum() - sizes["count"]).tolist()
        assert part["pos_below"].tolist() == (sizes["sum"].cumsum() - sizes["sum"]).tolist()
        assert set(part["n_all"]) == {len(known)}
        assert set(part["pos_all"]) == {known["y"].sum()}


@pytest.mark.parametrize("rows_per_bucket", [250_000, 100])
def test_running_counts_by_group(table, frame, rows_per_bucket):
    df = table.withColumn("g", (F.col("k") % 3).cast("int"))
    got = ranks.running_counts(
        df, ["hot"], "y", by=("g",), rows_per_bucket=rows_per_bucket
    ).toPandas()
    for g, part in got.groupby("g"):
        mine = frame[frame["k"] % 3 == g]
        part = part.sort_values("value")
        average = mine["hot"].rank().groupby(mine["hot"]).first()
        rank = part["n_below"] + (part["n"] + 1) / 2
        assert rank.tolist() == average.tolist()


def test_edges_stay_bounded(table, monkeypatch):
    """Buckets far smaller than the table do not grow what the driver holds; the counts stay the same."""
    asked, plain = [], ranks.bucket_edges

    def edges(df, columns, buckets):
        asked.append(buckets)
        return plain(df, columns, buckets)

    monkeypatch.setattr(ranks, "bucket_edges", edges)
    monkeypatch.setattr(ranks, "MOST_BUCKETS", 30)
    whole = ranks.running_counts(table, COLUMNS, "y")
    got = ranks.running_counts(table, COLUMNS, "y", rows_per_bucket=2)
    assert asked == [30]
    assert sorted(map(str, got.select(whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_no_single_task_under_row_windows(table):
    """Windows over values run per bucket; only bucket totals meet in one place."""
    df = ranks.running_counts(table, ["spread"], "y", rows_per_bucket=100)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "hashpartitioning(feature" in plan


def test_small_groups_are_shuffled_once_as_whole_rows(spark):
    rows = [(i % 40 if i % 41 else None, float(i * 7 % 23), None if i % 5 == 0 else i * 0.5, int(i % 3 == 0)) for i in range(800)]
    df = spark.createDataFrame(rows, "g int, a double, b double, y int")
    columns = ["a", "b"]
    whole = ranks.running_counts(df, columns, "y", by=["g"])
    dealt = ranks.running_counts(df, columns, "y", by=["g"], rows_per_bucket=50)
    assert sorted(map(str, dealt.select(whole.columns).collect())) == sorted(map(str, whole.collect()))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange ") == 1 and "hashpartitioning(g" in initial
