"""How features relate to each other and to the label."""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarescan.functions.columns import HASH_BITS, keyed_hash, long_form
from rarescan.operators.neighbors import neighbor_counts
from rarescan.operators.profile import small_table
from rarescan.operators.quantiles import exact_quantiles
from rarescan.operators.ranks import average_rank, running_counts, twice_rank
from rarescan.operators.sampling import class_counts, class_quota_sample
from rarescan.sources.shared import materialize

SIGNIFICANT = 0.05
EXACT_ROWS = 8  # of the smaller class, up to which Mann-Whitney p-values are exact
MI_BINS = 10
MI_NEIGHBORS = 3

# Rank lookups are broadcast up to this many distinct values in all (16 bytes each).
LOOKUP_VALUES = 500_000
# Values that make up more than 1/HOT_SHARE of the rows count as hot; there are
# at most HOT_SHARE of them per column, so their lookup has a fixed bound too.
HOT_SHARE = 10_000


# ---- rank correlation ---------------------------------------------------------


def _ranked(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    lookup_values: int | None = None,
    **rank_args,
) -> DataFrame:
    """The rank of every cell as ``<column>__rank``, less the mean rank; no column holds a null."""
    centred = average_rank() - (F.col("n_all") + 1) / F.lit(2.0)
    ranks = running_counts(df, columns, **rank_args).select(
        "feature", "value", "n", "n_all", centred.alias("rank")
    )
    # Written once; sizes, lookups and the join below all read it.
    ranks = materialize(ranks, "ranks")
    sizes = dict(ranks.groupBy("feature").agg(F.count("*")).collect())
    small, total, most = [], 0, LOOKUP_VALUES if lookup_values is None else lookup_values
    for c in sorted(columns, key=lambda c: sizes.get(c, 0)):
        total += sizes.get(c, 0)
        if total <= most:  # of all lookups together
            small.append(c)
    large = [c for c in columns if c not in small]
    cells = df.select(key, *[(F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in columns])
    out = cells.join(_ranks_of_large(cells, ranks, key, large), key) if large else cells
    for c in small:
        lookup = ranks.where(F.col("feature") == c)
        lookup = lookup.select(F.col("value").alias(c), F.col("rank").alias(f"{c}__rank"))
        out = out.join(F.broadcast(lookup), c)
    return out.select(*[f"{c}__rank" for c in columns])


def _ranks_of_large(df: DataFrame, ranks: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Ranks of columns with too many distinct values for a lookup.

    Hot values get their rank from a bounded broadcast, the rest by a join on
    (feature, value), which then has no hot key.
    """
    cells = long_form(df, {c: F.col(c) for c in columns}, [F.col(key)])
    is_hot = F.col("n") * HOT_SHARE > F.col("n_all")
    wanted = ranks.where(F.col("feature").isin(list(columns)))
    hot = wanted.where(is_hot).select("feature", "value", F.col("rank").alias("hot_rank"))
    rare = wanted.where(~is_hot).select("feature", "value", "rank")
    marked = cells.join(F.broadcast(hot), ["feature", "value"], "left")
    found = marked.where("hot_rank IS NOT NULL").select(key, "feature", F.col("hot_rank").alias("rank"))
    looked_up = (
        marked.where("hot_rank IS NULL")
        .join(rare, ["feature", "value"])
        .select(key, "feature", "rank")
    )
    return (
        found.unionByName(looked_up)
        .groupBy(key)
        .agg(*[F.max(F.when(F.col("feature") == c, F.col("rank"))).alias(f"{c}__rank") for c in columns])
    )


def _products(df: DataFrame) -> np.ndarray:
    """The sums of products of any two columns, in one pass: a matrix per task, added up by cell."""
    k = len(df.columns)

    def run(batches):
        total = np.zeros((k, k))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.ravel())], ["cell", "total"])

    sums = df.mapInArrow(run, "cell bigint, total double").groupBy("cell").agg(F.sum("total"))
    out = np.zeros(k * k)
    for cell, total in sums.collect():
        out[cell] = total
    return out.reshape(k, k)


def _complete_spearman(df: DataFrame, key: str, columns: Sequence[str], **rank_args) -> dict:
    """(col1, col2) -> rho of columns without nulls: Pearson's of the ranks.

    The ranks are less their mean, so a constant column is all zeros.
    """
    products = _products(_ranked(df, key, columns, **rank_args))

    def rho(i: int, j: int) -> float | None:
        if products[i, i] == 0 or products[j, j] == 0:
            return None
        if i == j:
            return 1.0
        return float(products[i, j] / math.sqrt(products[i, i]) / math.sqrt(products[j, j]))

    return {(a, b): rho(i, j) for i, a in enumerate(columns) for j, b in enumerate(columns)}


def spearman(df: DataFrame, key: str, columns: Sequence[str], **rank_args) -> DataFrame:
    """Spearman matrix in long form (col1, col2, rho).

    Tied values share their average rank.  Nulls are left out pair by pair: a cell
    comes from the rows that have both columns, ranked among themselves.  A
    constant column has no correlation, not even with itself, so its cells are null.
    """
    columns = list(columns)
    missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    gaps = [c for c in columns if missing[c]]
    clean = [c for c in columns if c not in gaps]
    cells = _complete_spearman(df, key, clean, **rank_args) if clean else {}
    for i, a in enumerate(gaps):
        rows = df.where(F.col(a).isNotNull())
        found = _complete_spearman(rows, key, [a, *clean], **rank_args)
        cells |= {pair: r for pair, r in found.items() if a in pair}
        for b in gaps[:i]:
            both = rows.where(F.col(b).isNotNull())
            found = _complete_spearman(both, key, [a, b], **rank_args)
            cells |= {(a, b): found[a, b], (b, a): found[b, a]}
    rows = [(a, b, cells[a, b]) for a in columns for b in columns]
    return small_table(df.sparkSession, rows, "col1 string, col2 string, rho double")


def target_correlation(matrix: DataFrame, label: str) -> DataFrame:
    """Features by their correlation with the label, largest first."""
    return (
        matrix.where((F.col("col2") == label) & (F.col("col1") != label))
        .select(F.col("col1").alias("feature"), "rho")
        .orderBy(F.col("rho").desc_nulls_last(), "feature")
    )


# ---- Mann-Whitney -----------------------------------------------------------------


@F.pandas_udf(T.DoubleType())
def two_sided_p(z: pd.Series) -> pd.Series:
    """P-value of a standard normal statistic; at most 1.  One row per feature."""
    return z.map(lambda v: min(1.0, math.erfc(v / math.sqrt(2.0))))


@lru_cache
def _ways(m: int) -> tuple[int, list[int]]:
    """How often parts of 1, 1, 2, ..., m add up to r, as a period and the numerator over (1 - q^period)^(m + 1)."""
    period = math.lcm(*range(1, m + 1))
    top = [1]
    for part in (1, *range(1, m + 1)):
        # times 1 + q^part + q^(2 part) + ... below the period
        grown = [0] * (len(top) + period - part)
        for at, ways in enumerate(top):
            grown[at] += ways
            if at + period < len(grown):
                grown[at + period] -= ways
        for at in range(part, len(grown)):
            grown[at] += grown[at - part]
        top = grown
    return period, top


def exact_p(n1: int, n2: int, u: int) -> float:
    """Two-sided p-value of U without ties, from how many of all orders give each U.

    The orders are counted by the Gaussian binomial coefficient: as a product over the
    smaller class it takes the same few sums of whole numbers whatever the other's size.
    """
    m, n = min(n1, n2), max(n1, n2)
    if m == 0:
        return 1.0
    most = min(u, n1 * n2 - u)  # U at or below it is as far out
    (period, top), shifts = _ways(m), {0: 1}
    for i in range(1, m + 1):  # the numerator, a product of 1 - q^(n + i)
        for at, sign in list(shifts.items()):
            shifts[at + n + i] = shifts.get(at + n + i, 0) - sign
    orders = 0
    for shift, sign in shifts.items():
        for turn in range((most - shift) // period, -1, -1) if most >= shift else ():
            at = most - shift - turn * period
            if at >= len(top):
                break
            orders += sign * top[at] * math.comb(turn + m, m)
    return min(1.0, float(Fraction(2 * orders, math.comb(n + m, m))))


@F.pandas_udf(T.DoubleType())
def exact_p_value(n1: pd.Series, n2: pd.Series, u: pd.Series) -> pd.Series:
    """One row per feature; null where the normal form holds."""
    rows = zip(n1, n2, u)
    return pd.Series([None if pd.isna(c) else exact_p(int(a), int(b), int(c)) for a, b, c in rows], dtype=float)


def mann_whitney(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    by: Sequence[str] = (),
    **rank_args,
) -> DataFrame:
    """Mann-Whitney U of positives against negatives per feature, two-sided.

    The p-value is exact where a class has at most ``EXACT_ROWS`` rows and no values are
    tied, else from the normal approximation with tie and continuity correction; p = 1 when
    all values are tied or a class is empty.
    """
    table = running_counts(df, columns, label, by=by, **rank_args)
    size = F.col("n").cast("double")
    sums = table.groupBy(*by, "feature").agg(
        F.max("pos_all").alias("n1"),
        (F.max("n_all") - F.max("pos_all")).alias("n2"),
        # twice the rank is a whole number: exact at any size and in any order
        F.sum(F.col("pos").cast("decimal(38,0)") * twice_rank()).cast("decimal(38,0)").alias("rank_sum"),
        F.sum(size * size * size - size).alias("ties"),
    )
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    least = F.col("n1").cast("decimal(19,0)") * (F.col("n1") + 1).cast("decimal(19,0)")
    u = (F.col("rank_sum") - least).cast("double") / 2
    variance = n1 * n2 / 12 * ((n + 1) - F.coalesce(F.try_divide(F.col("ties"), n * (n - 1)), F.lit(0.0)))
    larger = F.greatest(F.col("u_stat"), n1 * n2 - F.col("u_stat"))
    small = (F.col("ties") == 0) & F.least("n1", "n2").between(1, EXACT_ROWS)
    z = F.when(
        F.col("variance") > 1e-9, (larger - n1 * n2 / 2 - 0.5) / F.sqrt("variance")
    ).otherwise(F.lit(0.0))
    return (
        sums.withColumn("u_stat", u)
        .withColumn("variance", variance)
        .withColumn("z", z)
        .withColumn("exact", exact_p_value("n1", "n2", F.when(small, F.col("u_stat"))))
        .withColumn("p_value", F.when(small, F.col("exact")).otherwise(two_sided_p("z")))
        .select(
            *by,
            "feature",
            "n1",
            "n2",
            "u_stat",
            F.col("z").alias("z"),
            "p_value",
            F.when(F.col("p_value") < SIGNIFICANT, "significant")
            .otherwise("not significant")
            .alias("conclusion"),
        )
        .orderBy(*by, "p_value", "feature")
    )


def mann_whitney_sample(
    df: DataFrame, key: str, label: str, salt: str, per_class: int | None = None
) -> DataFrame:
    """The rows to test: all of them, or ``per_class`` of each class where it is given."""
    if per_class is None:
        return df
    return class_quota_sample(df, key, label, {1: per_class, 0: per_class}, salt)


# ---- mutual information --------------------------------------------------------------


def mi_binned(
    df: DataFrame, columns: Sequence[str], label: str, bins: int = MI_BINS, **quantile_args
) -> DataFrame:
    """Mutual information with the label in nats over quantile bins; nulls count as 0.

    ``mi_adjusted`` takes off the expected value under independence,
    (bins - 1)(classes - 1) / 2n, and is never negative.
    """
    filled = [(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0))) for c in columns]
    cuts = exact_quantiles(df, filled, [i / bins for i in range(1, bins)], **quantile_args)
    # Bins are closed on the right.  Bucketizer closes them on the left, so it
    # gets the negated values and edges.
    edges = {c: sorted({-e + 0.0 for e in cuts[c] if e is not None}) for c in columns}
    cut = [c for c in columns if edges[c]]
    binned = Bucketizer(
        splitsArray=[[float("-inf"), *edges[c], float("inf")] for c in cut],
        inputCols=[f"{c}__negated" for c in cut],
        outputCols=[f"{c}__bin" for c in cut],
    ).transform(df.select(F.col(label).alias("y"), *[(F.lit(0.0) - v).alias(f"{c}__negated") for c, v in filled]))
    cells = (
        long_form(binned, {c: F.col(f"{c}__bin").cast("int") for c in cut}, [F.col("y")])
        .groupBy("feature", F.col("value").alias("bin"), "y")
        .agg(F.count("*").alias("n_xy"))
    )
    # From here on there are at most features x bins x classes rows.
    per_bin, per_class = Window.partitionBy("feature", "bin"), Window.partitionBy("feature", "y")
    whole = Window.partitionBy("feature")
    n_xy, n = F.col("n_xy").cast("double"), F.col("n")
    scored = (
        cells.withColumns(
            {
                "n_x": F.sum("n_xy").over(per_bin).cast("double"),
                "n_y": F.sum("n_xy").over(per_class),
                "n": F.sum("n_xy").over(whole),
            }
        )
        .groupBy("feature")
        .agg(
            F.sum(n_xy / n * F.log(n_xy * n / (F.col("n_x") * F.col("n_y")))).alias("mi"),
            (
                (F.countDistinct("bin") - 1) * (F.countDistinct("y") - 1) / (2 * F.max("n"))
            ).alias("bias"),
        )
    )
    return scored.select(
        "feature",
        F.abs("mi").alias("mi"),
        F.greatest(F.col("mi") - F.col("bias"), F.lit(0.0)).alias("mi_adjusted"),
    ).orderBy(F.desc("mi"), "feature")


# Values lie on a grid of whole numbers, so that every engine and every task
# compares the same distances: this many steps over a column's range, and a jitter of
# this many steps within each from the keyed hash, so that equal values break evenly.
MI_STEPS, MI_JITTER_BITS = 1 << 40, 20


def digamma(n: Column) -> Column:
    """Digamma at whole numbers from 1: an asymptotic series at n + 8, stepped back."""
    x = n.cast("double") + 8
    series = F.log(x) - 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * F.pow(x, 4)) - 1 / (252 * F.pow(x, 6))
    for j in range(8):
        series = series - 1 / (n.cast("double") + j)
    return series


def _places(df: DataFrame, key: str, columns: Sequence[str], salt: str) -> dict[str, Column]:
    """Every cell as a place on its column's grid; nulls count as 0."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    ends = df.agg(
        *[F.min(v).alias(f"lo__{c}") for c, v in filled.items()],
        *[F.max(v).alias(f"hi__{c}") for c, v in filled.items()],
    ).first()

    def place(c: str) -> Column:
        lo, hi = ends[f"lo__{c}"], ends[f"hi__{c}"]
        jitter = keyed_hash(F.concat_ws(":", F.col(key), F.lit(c)), salt)
        jitter = F.shiftright(jitter, HASH_BITS - MI_JITTER_BITS)
        if lo is None or lo == hi:
            return jitter
        step = F.floor((filled[c] - F.lit(lo)) / (F.lit(hi) - F.lit(lo)) * float(MI_STEPS))
        return step.cast("bigint") * (1 << MI_JITTER_BITS) + jitter

    return {c: place(c) for c in columns}


def _grid(df: DataFrame, key: str, columns: Sequence[str], label: str, salt: str) -> DataFrame:
    """(key, y, feature, v): the places in long form."""
    cells = _places(df, key, columns, salt)
    return long_form(df, cells, [F.col(key).alias("key"), F.col(label).alias("y")]).select(
        "key", "y", "feature", F.col("value").alias("v")
    )


def _with_twins(df: DataFrame, key: str, label: str) -> DataFrame:
    """The rows with ``__twin``: a number that rows of one key and label share, null for a row alone."""
    many = df.groupBy(F.col(key).alias("__twin_key"), F.col(label).alias("__twin_y")).count()
    many = many.where("count > 1").select("__twin_key", "__twin_y", F.monotonically_increasing_id().alias("__twin"))
    many = materialize(many, "twins")
    if many.isEmpty():
        return df.withColumn("__twin", F.lit(None).cast("bigint"))
    same = F.col(key).eqNullSafe(F.col("__twin_key")) & (F.col(label) == F.col("__twin_y"))
    return df.join(many, same, "left")


def mi_knn(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    label: str,
    salt: str,
    k: int = MI_NEIGHBORS,
    **block_args,
) -> DataFrame:
    """Nearest-neighbour mutual information with a discrete label (Ross 2014), on all rows.

    Classes of one row are left out.  Per cell: the distance to its k-th nearest of
    its class, then how many cells of any class are nearer.  Rows of one key and class
    are one term, of the sum of their counts.
    """
    columns = list(columns)
    counts = {c: n for c, n in class_counts(df, label).items() if c is not None and n > 1}
    used = _with_twins(df.where(F.col(label).isin(list(counts))), key, label)
    class_of = nearest = size = F.lit(None).cast("bigint")
    for i, (c, n) in enumerate(counts.items()):
        class_of = F.when(F.col(label) == F.lit(c), F.lit(i)).otherwise(class_of)
        nearest = F.when(F.col("class") == i, F.lit(min(k, n - 1))).otherwise(nearest)
        size = F.when(F.col("class") == i, F.lit(n)).otherwise(size)
    cells = list(_places(used, key, columns, salt).values())
    counted = neighbor_counts(used, cells, class_of, F.col("__twin"), list(counts.values()), k, **block_args)
    term = digamma(nearest) - digamma(size) - digamma(F.greatest("within", F.lit(1)))
    terms = counted.select(
        F.get(F.array(*map(F.lit, columns)), F.col("feature")).alias("feature"), "n", (F.col("n") * term).alias("term")
    )
    mi = terms.groupBy("feature").agg(
        F.greatest(F.lit(0.0), digamma(F.sum("n")) + F.sum("term") / F.sum("n")).alias("mi")
    )
    return mi.orderBy(F.desc("mi"), "feature")


# ---- screening -------------------------------------------------------------------------

# Limits the screening decisions go by.
CLIP_ABOVE_PCT = 15.0
MI_FLOOR = 0.0001


def screen_features(
    described: DataFrame, outliers: DataFrame, mi: DataFrame, tests: DataFrame
) -> DataFrame:
    """What to do with each feature: drop, clip or keep, and why.

    Drop what never varies or shows no sign of the label (no mutual information
    and no significant rank test); clip what has many outliers.
    """
    facts = (
        described.select("feature", "std")
        .join(outliers.select("feature", "outlier_pct"), "feature", "left")
        .join(mi.select("feature", "mi_adjusted"), "feature", "left")
        .join(tests.select("feature", "p_value"), "feature", "left")
    )
    constant = F.coalesce(F.col("std"), F.lit(0.0)) == 0
    silent = (F.col("mi_adjusted") < MI_FLOOR) & (F.col("p_value") >= SIGNIFICANT)
    wide = F.col("outlier_pct") > CLIP_ABOVE_PCT
    return facts.select(
        "feature",
        F.when(constant | silent, "drop").when(wide, "clip").otherwise("keep").alias("action"),
        F.when(constant, "constant")
        .when(silent, "no signal")
        .when(wide, "many outliers")
        .otherwise("")
        .alias("reason"),
    ).orderBy("feature")


