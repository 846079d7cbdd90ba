import hashlib

import pytest
from pyspark.sql import functions as F

from rarescan.operators import sampling


def hashed(key, salt):
    return int(hashlib.md5(f"{key}:{salt}".encode()).hexdigest()[:13], 16)


@pytest.fixture(scope="module")
def rows(spark):
    # every tenth row is positive
    return spark.range(5000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y")
    ).cache()


def keys(df):
    return {r["k"] for r in df.select("k").collect()}


def test_split_is_complete_disjoint_and_stable(rows):
    split = sampling.with_split(rows, "k", 0.2, "s")
    test = keys(split.where("split = 'test'"))
    train = keys(split.where("split = 'train'"))
    assert test | train == set(range(5000)) and not test & train
    assert test == {k for k in range(5000) if hashed(k, "s") < int(0.2 * 16**13)}
    again = sampling.with_split(rows.repartition(13), "k", 0.2, "s")
    assert keys(again.where("split = 'test'")) == test


def test_exact_split_takes_smallest_hashes_per_class(rows):
    split = sampling.with_exact_split(rows, "k", "y", 0.2, "s")
    for y, n in ((1, 500), (0, 4500)):
        mine = [k for k in range(5000) if (k % 10 == 0) == (y == 1)]
        want = set(sorted(mine, key=lambda k: hashed(k, "s"))[: n // 5])
        assert keys(split.where(f"split = 'test' AND y = {y}")) == want


def test_equal_hashes_at_the_cut_go_by_key(rows):
    counts = {0: 4500, 1: 500}
    chosen = sampling._smallest(
        rows, "k", "s", {0: 7, 1: 3}, "y", counts, order=F.lit(5).cast("bigint")
    )
    got = rows.where(chosen)
    assert keys(got.where("y = 1")) == {0, 10, 20}
    assert keys(got.where("y = 0")) == {1, 2, 3, 4, 5, 6, 7}


def test_sample_rows(rows):
    want = set(sorted(range(5000), key=lambda k: hashed(k, "a"))[:700])
    assert keys(sampling.sample_rows(rows, "k", 700, "a")) == want
    assert sampling.sample_rows(rows, "k", 9999, "a").count() == 5000


def test_quota_sample_is_capped_at_what_is_there(rows):
    got = sampling.class_quota_sample(rows, "k", "y", {1: 900, 0: 50}, "q")
    assert sampling.class_counts(got, "y") == {1: 500, 0: 50}
    assert sampling.class_counts(sampling.class_quota_sample(rows, "k", "y", {1: 2}, "q"), "y") == {1: 2}


def test_demo_quotas():
    assert sampling.demo_quotas(5, 100) == {1: 2, 0: 3}
    assert sampling.demo_quotas(1, 100) == {1: 1, 0: 0}
    assert sampling.demo_quotas(10, 3) == {1: 3, 0: 7}


def test_undersample(rows):
    got = sampling.class_counts(sampling.undersample(rows, "k", "y", 0.5, "u"), "y")
    assert got[1] == 500 and 850 < got[0] < 1150
    with pytest.raises(ValueError, match="more negatives"):
        sampling.undersample(rows, "k", "y", 0.05, "u")
    with pytest.raises(ValueError, match="more negatives"):
        sampling.undersample(rows.where("y = 1"), "k", "y", 0.5, "u")


def test_replicate_minority_keeps_every_row(rows):
    got = sampling.replicate_minority(rows, "k", "y", "r")
    counts = sampling.class_counts(got, "y")
    assert counts == {0: 4500, 1: 4500}
    assert keys(got) == set(range(5000))


def test_folds(rows):
    folded = sampling.with_folds(rows, "k", 3, "f")
    got = {r["k"]: r["fold"] for r in folded.collect()}
    assert got == {k: hashed(k, "f") % 3 for k in range(5000)}


def test_exact_folds_are_balanced(rows):
    folded = sampling.with_exact_folds(rows, "k", "y", 3, "f")
    for y, n in ((0, 4500), (1, 500)):
        sizes = [r["count"] for r in folded.where(f"y = {y}").groupBy("fold").count().collect()]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_weights(rows):
    assert sampling.balanced_weights({0: 90, 1: 10}) == {0: 100 / 180, 1: 5.0}
    weighted = sampling.with_weights(rows, "y", sampling.positive_weight(90))
    assert weighted.agg(F.sum("weight")).first()[0] == 500 * 90 + 4500
    assert not sampling.use_sample_weights(True, 0.5)
    assert sampling.use_sample_weights(True, None)


def test_one_class_only(spark):
    df = spark.range(20).select(F.col("id").alias("k"), F.lit(0).alias("y"))
    split = sampling.with_exact_split(df, "k", "y", 0.2, "s")
    assert split.where("split = 'test'").count() == 4
