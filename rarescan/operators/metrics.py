"""Predictions at a threshold and the metrics of the 2 x 2 table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarescan.functions.columns import ratio0

DEFAULT_THRESHOLD = 0.5


def predicted(score: str | Column, threshold: float | Column) -> Column:
    """1 when the score reaches the threshold (inclusive)."""
    score = F.col(score) if isinstance(score, str) else score
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score >= limit).cast("int")


def confusion_counts(df: DataFrame, label: str, cuts: Mapping[str, tuple[str, float]]) -> DataFrame:
    """tn, fp, fn, tp for several (score column, threshold) pairs in one pass.

    ``cuts`` maps a name to its pair.  Empty cells are 0.
    """
    y = F.col(label)
    aggregates, entries = [], []
    for i, (name, (score, threshold)) in enumerate(cuts.items()):
        hit = predicted(score, threshold)
        for cell, (actual, guess) in {
            "tn": (0, 0),
            "fp": (0, 1),
            "fn": (1, 0),
            "tp": (1, 1),
        }.items():
            aggregates.append(F.count(F.when((y == actual) & (hit == guess), 1)).alias(f"{cell}{i}"))
        entries.append(
            F.struct(
                F.lit(name).alias("name"),
                F.lit(score).alias("model"),
                F.lit(float(threshold)).alias("threshold"),
                *[F.col(f"{cell}{i}").alias(cell) for cell in ("tn", "fp", "fn", "tp")],
            )
        )
    return df.agg(*aggregates).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def confusion_cells(counts: DataFrame, label: str = "label") -> DataFrame:
    """The same table with one row per cell."""
    cells = [
        F.struct(
            F.lit(actual).alias(label), F.lit(guess).alias("predicted"), F.col(cell).alias("n")
        )
        for cell, actual, guess in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    ]
    keep = ["name", "model", "threshold"]
    return counts.select(*keep, F.explode(F.array(*cells)).alias("e")).select(*keep, "e.*")


def _scores(hit: str, false_alarm: str, miss: str) -> tuple[Column, Column, Column]:
    p = ratio0(F.col(hit), F.col(hit) + F.col(false_alarm))
    r = ratio0(F.col(hit), F.col(hit) + F.col(miss))
    f1 = ratio0(2 * F.col(hit), 2 * F.col(hit) + F.col(false_alarm) + F.col(miss))
    return p, r, f1


def binary_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 (0 when undefined), accuracy and the four rates."""
    p, r, f1 = _scores("tp", "fp", "fn")
    positives, negatives = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    return counts.select(
        *counts.columns,
        p.alias("precision"),
        r.alias("recall"),
        f1.alias("f1"),
        ratio0(F.col("tp") + F.col("tn"), positives + negatives).alias("accuracy"),
        ratio0(F.col("tn"), negatives).alias("tn_rate"),
        ratio0(F.col("fp"), negatives).alias("fp_rate"),
        ratio0(F.col("tp"), positives).alias("tp_rate"),
        ratio0(F.col("fn"), positives).alias("fn_rate"),
    )


def class_report(counts: DataFrame) -> DataFrame:
    """Per-class, macro and weighted precision, recall, F1 and support."""
    neg, pos = _scores("tn", "fn", "fp"), _scores("tp", "fp", "fn")
    s0, s1 = F.col("tn") + F.col("fp"), F.col("tp") + F.col("fn")
    total = s0 + s1

    def row(group: str, values, support: Column) -> Column:
        return F.struct(
            F.lit(group).alias("class"),
            *[v.alias(n) for n, v in zip(("precision", "recall", "f1"), values)],
            support.alias("support"),
        )

    rows = [
        row("0", neg, s0),
        row("1", pos, s1),
        row("macro avg", [(a + b) / 2 for a, b in zip(neg, pos)], total),
        row("weighted avg", [ratio0(a * s0 + b * s1, total) for a, b in zip(neg, pos)], total),
    ]
    return counts.select("name", F.explode(F.array(*rows)).alias("e")).select("name", "e.*")


def compare_thresholds(
    df: DataFrame, label: str, tuned: Mapping[str, float], default: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Default against tuned threshold per score: both metric sets and the gain."""
    cuts = {}
    for score, threshold in tuned.items():
        cuts[f"{score}|default"] = (score, default)
        cuts[f"{score}|tuned"] = (score, threshold)
    measured = binary_metrics(confusion_counts(df, label, cuts))
    out = measured.groupBy("model").agg(
        *[
            F.max(F.when(F.col("name").endswith(f"|{which}"), F.col(m))).alias(f"{m}_{which}")
            for m in ("f1", "precision", "recall")
            for which in ("default", "tuned")
        ]
    )
    return out.withColumns(
        {
            f"{m}_gain": (F.col(f"{m}_tuned") - F.col(f"{m}_default"))
            for m in ("f1", "precision", "recall")
        }
    )
