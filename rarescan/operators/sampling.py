"""Splits, samples, folds and class weights.

Everything hangs on one keyed hash per row, so results do not depend on the
order or partitioning of the data.  A fraction is a plain filter on the hash;
an exact count is the same filter at an exact order statistic of the hash, so
no row is ever moved or ranked in a window.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarescan.functions.columns import hash_cut, keyed_hash
from rarescan.operators.quantiles import rank_values

TRAIN, TEST = "train", "test"


def class_counts(df: DataFrame, label: str) -> dict:
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}


# ---- splits -----------------------------------------------------------------


def with_split(
    df: DataFrame, key: str, test_fraction: float, salt: str, column: str = "split"
) -> DataFrame:
    """Stateless train/test column; class shares hold in expectation."""
    in_test = keyed_hash(key, salt) < hash_cut(test_fraction)
    return df.withColumn(column, F.when(in_test, TEST).otherwise(TRAIN))


def with_exact_split(
    df: DataFrame, key: str, label: str, test_fraction: float, salt: str, column: str = "split"
) -> DataFrame:
    """Train/test column with exactly ``floor(n_class * fraction + 0.5)`` test rows per class."""
    counts = class_counts(df, label)
    quota = {c: int(n * test_fraction + 0.5) for c, n in counts.items()}
    chosen = _smallest(df, key, salt, quota, label, counts)
    return df.withColumn(column, F.when(chosen, TEST).otherwise(TRAIN))


def _smallest(
    df: DataFrame,
    key: str,
    salt: str,
    quota: Mapping,
    label: str | None,
    counts: Mapping,
    order: Column | None = None,
) -> Column:
    """Condition that holds for the ``quota`` rows with the smallest hash per class."""
    order = keyed_hash(key, salt) if order is None else order

    def belongs(c) -> Column:
        return F.lit(True) if label is None else F.col(label).eqNullSafe(F.lit(c))

    targets = [
        (c, F.when(belongs(c), order), quota[c] - 1, counts[c])
        for c in counts
        if 0 < quota[c] < counts[c]
    ]
    cuts = rank_values(df, targets) if targets else {}
    # Equal hashes at the cut are settled by key, so the count stays exact.
    ties = {}
    if cuts:
        row = df.agg(
            *[
                part
                for i, (c, cut) in enumerate(cuts.items())
                for part in (
                    F.count(F.when(belongs(c) & (order < F.lit(cut)), 1)).alias(f"b{i}"),
                    F.count(F.when(belongs(c) & (order == F.lit(cut)), 1)).alias(f"e{i}"),
                )
            ]
        ).first()
        for i, c in enumerate(cuts):
            ties[c] = (quota[c] - row[f"b{i}"], row[f"e{i}"])
    result = F.lit(False)
    for c in counts:
        if quota[c] <= 0:
            continue
        if quota[c] >= counts[c]:
            condition = F.lit(True)
        elif ties[c][0] == ties[c][1]:
            condition = order <= F.lit(cuts[c])
        else:
            at_cut = df.where(belongs(c) & (order == F.lit(cuts[c])))
            last = at_cut.select(key).orderBy(key).limit(ties[c][0]).agg(F.max(key)).first()[0]
            condition = (order < F.lit(cuts[c])) | (
                (order == F.lit(cuts[c])) & (F.col(key) <= F.lit(last))
            )
        result = result | (belongs(c) & condition)
    return result


# ---- samples ----------------------------------------------------------------


def sample_rows(df: DataFrame, key: str, n: int, salt: str) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement."""
    total = df.count()
    if n >= total:
        return df
    return df.where(_smallest(df, key, salt, {None: n}, None, {None: total}))


def class_quota_sample(
    df: DataFrame, key: str, label: str, quotas: Mapping, salt: str
) -> DataFrame:
    """A fixed number of rows per class, capped at what is there."""
    counts = {c: n for c, n in class_counts(df, label).items() if quotas.get(c, 0) > 0}
    quota = {c: min(quotas[c], n) for c, n in counts.items()}
    return df.where(_smallest(df, key, salt, quota, label, counts))


def demo_quotas(n_samples: int, positives: int) -> dict:
    """About half positives, at least one, for a small demonstration mix."""
    n_pos = min(positives, max(1, n_samples // 2))
    return {1: n_pos, 0: n_samples - n_pos}


def shuffled(df: DataFrame, key: str, salt: str) -> DataFrame:
    """Order rows by hash: a reproducible shuffle (a range sort, not one task)."""
    return df.orderBy(keyed_hash(key, salt), key)


def stratified_subsample(df: DataFrame, key: str, label: str, n: int, salt: str) -> DataFrame:
    """About ``n`` rows with the class shares of the input; the input when smaller."""
    total = df.count()
    return df if total <= n else df.where(keyed_hash(key, salt) < hash_cut(n / total))


def undersample(
    df: DataFrame,
    key: str,
    label: str,
    ratio: float,
    salt: str,
    counts: Mapping | None = None,
) -> DataFrame:
    """All positives, and negatives thinned so that positives/negatives = ratio."""
    counts = counts or class_counts(df, label)
    wanted, there = counts.get(1, 0) / ratio, counts.get(0, 0)
    keep = wanted / there if there else math.inf
    if keep > 1:
        raise ValueError(f"ratio {ratio} would need more negatives than there are")
    return df.where((F.col(label) == 1) | (keyed_hash(key, salt) < hash_cut(keep)))


def replicate_minority(
    df: DataFrame, key: str, label: str, salt: str, counts: Mapping | None = None
) -> DataFrame:
    """Repeat positives until both classes weigh the same.

    Stands in for sample weights where a learner takes none.  No row is lost;
    the table at most doubles.
    """
    counts = counts or class_counts(df, label)
    if not counts.get(1) or counts[1] >= counts.get(0, 0):
        return df
    weight = counts[0] / counts[1]
    whole, part = int(weight), weight - int(weight)
    copies = F.when(F.col(label) != 1, 1).otherwise(
        F.lit(whole) + (keyed_hash(key, salt) < hash_cut(part)).cast("int")
    )
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


# ---- folds ------------------------------------------------------------------


def fold_column(key: str, folds: int, salt: str) -> Column:
    return F.pmod(keyed_hash(key, salt), F.lit(folds)).cast("int")


def with_folds(
    df: DataFrame, key: str, folds: int, salt: str, column: str = "fold"
) -> DataFrame:
    """Fold number from the keyed hash; class shares hold in expectation."""
    return df.withColumn(column, fold_column(key, folds, salt))


def with_exact_folds(
    df: DataFrame, key: str, label: str, folds: int, salt: str, column: str = "fold"
) -> DataFrame:
    """Folds whose class counts differ by at most one row (equal hashes stay together).

    The cuts are exact hash quantiles per class: (folds - 1) numbers per class.
    """
    order = keyed_hash(key, salt)
    counts = class_counts(df, label)
    targets = []
    for c, n in counts.items():
        for f in range(1, folds):
            end = n * f // folds
            if 0 < end < n:
                own = F.when(F.col(label).eqNullSafe(F.lit(c)), order)
                targets.append(((c, f), own, end - 1, n))
    cuts = rank_values(df, targets) if targets else {}
    fold = F.lit(0)
    for (c, _), cut in cuts.items():
        past = F.col(label).eqNullSafe(F.lit(c)) & (order > F.lit(cut))
        fold = fold + past.cast("int")
    return df.withColumn(column, fold)


# ---- weights ----------------------------------------------------------------


def balanced_weights(counts: Mapping) -> dict:
    """n / (classes * n_class) for every class."""
    total = sum(counts.values())
    return {c: total / (len(counts) * n) for c, n in counts.items() if n}


def with_weights(
    df: DataFrame, label: str, weights: Mapping, column: str = "weight"
) -> DataFrame:
    """Attach class weights as literals; one value per class, no join."""
    expr = F.lit(1.0)
    for c, w in weights.items():
        expr = F.when(F.col(label) == F.lit(c), F.lit(float(w))).otherwise(expr)
    return df.withColumn(column, expr)


def positive_weight(weight: float) -> dict:
    return {1: weight, 0: 1.0}


def use_sample_weights(wanted: bool, undersampling_ratio: float | None) -> bool:
    """Sample weights are off once undersampling already balanced the classes."""
    return wanted and undersampling_ratio is None


def split_summary(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows, positives and positive rate per split."""
    return df.groupBy(split).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col(label).cast("bigint")).alias("n_pos"),
        F.avg(F.col(label).cast("double")).alias("pos_rate"),
    )


