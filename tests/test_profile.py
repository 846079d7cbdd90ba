import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rarescan.operators import profile


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        (1, 10, 1.5, "a", 0),
        (2, 127, -0.0, "b", 1),
        (3, -128, 0.0, None, 1),
        (4, 300, None, "a", 0),
        (5, 70000, 2.5, "c", 0),
        (5, 70000, 2.5, "c", 0),
    ]
    return spark.createDataFrame(rows, "k long, whole long, real double, word string, y int")


def as_dict(df, key="feature"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_type_plan_limits_are_strict(spark):
    df = spark.createDataFrame(
        [(126, 127, -127, -128, 1.0), (0, 0, 0, 0, 2.0)],
        "a long, b long, c long, d long, e double",
    )
    plan = profile.type_plan(df, list("abcde"))
    kinds = {r["feature"]: r["chosen_type"] for r in plan.collect()}
    # the ends of a type's range do not count as fitting
    assert kinds == {"a": "tinyint", "b": "smallint", "c": "tinyint", "d": "smallint", "e": "double"}
    narrow = profile.narrow_types(df, plan)
    assert [f.dataType.simpleString() for f in narrow.schema] == list(kinds.values())
    wide = profile.type_plan(df, ["e"], narrow_floats=True).first()
    assert wide["chosen_type"] == "float"


def test_quality(table):
    got = as_dict(profile.quality_table(table, ["k", "whole", "real", "word"]))
    assert got["real"]["null_count"] == 1 and got["real"]["n_distinct"] == 3  # -0.0 is 0.0
    assert got["word"]["null_count"] == 1 and got["word"]["n_distinct"] == 3
    assert got["k"]["null_pct"] == 0 and got["k"]["dtype"] == "bigint"


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2.0), (1, None)], "a int, b double")
    assert profile.duplicate_rows(df).first()["n_duplicates"] == 2
    assert profile.duplicate_rows(df.limit(0)).first()["n_rows"] == 0


def test_describe_matches_pandas(spark):
    values = pd.DataFrame({"a": np.random.default_rng(0).normal(size=501), "b": np.arange(501.0)})
    got = as_dict(profile.describe_numeric(spark.createDataFrame(values), ["a", "b"]))
    for c, row in values.describe().items():
        for ours, theirs in (("mean", "mean"), ("std", "std"), ("p25", "25%"), ("max", "max")):
            assert got[c][ours] == pytest.approx(row[theirs])


def test_outliers_are_strictly_outside(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 7, 8]], "v double")
    q1, q3 = 2.25, 6.25
    low, high = q1 - 6, q3 + 6
    more = df.union(spark.createDataFrame([(low,), (high,)], "v double"))
    got = profile.iqr_outliers(more, ["v"], quartiles={"v": [q1, 3.5, q3]}).first()
    assert (got["lower_bound"], got["upper_bound"], got["outliers"]) == (low, high, 0)
    flat = spark.createDataFrame([(0.0,)] * 9 + [(1.0,)], "v double")
    assert profile.iqr_outliers(flat, ["v"]).first()["outliers"] == 1


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(3).integers(0, 1000, 3000).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"v": values, "c": 4.0}))
    got = profile.histogram(df, ["v", "c"]).toPandas()
    counts = np.zeros(30, int)
    part = got[got["feature"] == "v"]
    counts[part["bin"]] = part["n"]
    assert counts.sum() == 3000
    assert counts.tolist() == np.histogram(values, bins=30)[0].tolist()
    constant = got[got["feature"] == "c"]
    assert constant[["bin", "bin_start", "n"]].values.tolist() == [[15, 4.0, 3000]]


def test_box_stats(spark):
    df = spark.createDataFrame(
        [(float(v), 0) for v in [1, 2, 3, 4, 100]] + [(5.0, 1)], "v double, y int"
    )
    got = {r["class"]: r for r in profile.box_stats(df, ["v"], "y").collect()}
    assert got[0]["whisker_high"] == 4 and got[0]["outliers"] == 1 and got[0]["median"] == 3
    assert got[1]["q1"] == got[1]["whisker_low"] == 5


def test_domain_lists_or_ranks(spark):
    many = [(f"v{i:02d}",) for i in range(31)] + [("v07",)] * 3 + [("v20",)] * 3
    got = profile.category_domain(spark.createDataFrame(many, "w string"), ["w"]).first()
    assert got["n_values"] == 31 and got["domain"] == ["v07", "v20", "v00", "v01", "v02"]
    few = spark.createDataFrame([("b",), ("a",), (None,)], "w string")
    got = profile.category_domain(few, ["w"]).first()
    assert got["n_values"] == 3 and got["domain"] == [None, "a", "b"]


def test_domain_keeps_odd_values_apart(spark):
    rows = [("a,b",), ("a",), ("b",), ("",), (None,)]
    got = profile.category_domain(spark.createDataFrame(rows, "w string"), ["w"]).first()
    assert got["domain"] == [None, "", "a", "a,b", "b"]


def test_all_columns_have_boxes(spark):
    wide = spark.range(20).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(30)], F.lit(1).alias("y"))
    got = profile.box_stats(wide, [f"c{i}" for i in range(30)], "y").collect()
    assert len(got) == 30


def test_duplicates_by_hash_and_row(spark):
    rows = [(None, 5), (5, None), (5, None), (1, 1), (1, 1), (1, 1)]
    got = profile.duplicate_rows(spark.createDataFrame(rows, "a int, b int")).first()
    assert (got["n_rows"], got["n_duplicates"]) == (6, 3)
    none = spark.createDataFrame([], "a int, b int")
    assert profile.duplicate_rows(none).first()["n_duplicates"] == 0


def test_risk_leaves_out_nulls(table):
    got = profile.categorical_risk(table, ["word"], "y").collect()
    assert [(r["value"], r["n"], r["pos_rate"]) for r in got] == [("b", 1, 1), ("a", 2, 0), ("c", 2, 0)]
    assert profile.categorical_risk(table, ["word"], "y", max_values=2).count() == 0


def test_target_and_period(table):
    got = {r["y"]: r["pct"] for r in profile.target_distribution(table, "y").collect()}
    assert got[1] == pytest.approx(100 / 3)
    assert profile.rate_by_period(table, "month", "y") is None
    by_key = profile.rate_by_period(table, "k", "y").collect()
    assert [(r["k"], r["n"], r["pos"]) for r in by_key][-1] == (5, 2, 0)


def test_class_profile(table):
    got = {
        (r["feature"], r["class"]): r
        for r in profile.class_profile(table, ["real"], ["word"], "y").collect()
    }
    assert len(got) == 6
    assert got["real", None]["n_distinct"] == 3 and got["real", None]["missing"] == 1
    assert got["real", 1]["n_distinct"] == 1 and got["real", 1]["p50"] == 0
    assert got["word", 0]["n"] == 4 and got["word", 0]["pos_rate"] == 0
    assert got["word", None]["pos_rate"] == pytest.approx(1 / 3)
