"""Distributed ranks and running counts.

Ranks, curves and rank tests all need counts "below this value".  Rows are
first aggregated to one row per distinct value (hot values collapse before
the shuffle), values are spread over range buckets, counts run inside a bucket,
and bucket totals are added.  Buckets only steer the parallelism: any edges
give the same exact result.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rarescan.functions.columns import long_form, unpivot_structs
from rarescan.sources.shared import materialize

ROWS_PER_BUCKET = 250_000
MOST_BUCKETS = 1_000  # per column: what the driver and each task hold of the edges stays bounded; windows spill
CELLS_PER_TASK = 2_000_000  # where whole rows are dealt by group


def bucket_edges(df: DataFrame, columns: Sequence[str], buckets: int) -> dict[str, list[float]]:
    """Approximate row quantiles per column, as strictly increasing edges."""
    probs = [i / buckets for i in range(1, buckets)]
    accuracy = max(1_000, 10 * buckets)  # a tenth of a bucket; one task merges the sketches of all others
    out: dict[str, list[float]] = {}
    for start in range(0, len(columns), 50):
        chunk = columns[start : start + 50]
        row = df.agg(
            *[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(c) for c in chunk]
        ).first()
        # adding 0.0 turns -0.0 into 0.0, which a binary search tells apart
        out.update({c: sorted({e + 0.0 for e in row[c] or ()}) for c in chunk})
    return out


def with_buckets(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Add ``<column>__bucket`` by binary search over the column's edges."""
    cut = [c for c, e in edges.items() if e]
    if cut:
        names = [f"{c}__value" for c in cut]
        df = df.withColumns({n: F.col(c).cast("double") + F.lit(0.0) for n, c in zip(names, cut)})
        df = Bucketizer(
            splitsArray=[[float("-inf"), *edges[c], float("inf")] for c in cut],
            inputCols=names,
            outputCols=[f"{c}__bucket" for c in cut],
            handleInvalid="keep",
        ).transform(df)
    flat = {f"{c}__bucket": F.lit(0.0) for c, e in edges.items() if not e}
    return df.withColumns(flat) if flat else df


def running_counts(
    df: DataFrame,
    columns: Iterable[str],
    label: str | None = None,
    by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per (by, feature, value) with counts below it.

    Columns: ``n`` rows and ``pos`` positives at the value, ``n_below`` and
    ``pos_below`` strictly below it, ``n_all`` and ``pos_all`` in its (by,
    feature) group.  Null values are left out.
    """
    columns = list(columns)
    kept = df.select(*by, *columns, *([label] if label and label not in columns else []))
    rows = kept.count()
    buckets = rows // rows_per_bucket
    if buckets <= 1:
        return _counts_in_one_bucket(_value_table(kept, columns, label, by), by)
    if by and _largest_group(kept, by) <= rows_per_bucket:
        # no window holds more than a bucket: rows are shuffled whole, once, and unfold where they are
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = kept.repartition(max(parts, rows * len(columns) // CELLS_PER_TASK), *by)
        return _counts_in_one_bucket(_dealt_value_table(dealt, columns, label, by), by)
    edges = bucket_edges(kept, columns, min(buckets, MOST_BUCKETS))
    values = _bucketed_value_table(kept, columns, label, by, edges)
    # Read twice below; the rows behind it are read once.
    return _counts_over_buckets(materialize(values, "values"), by)


def _largest_group(df: DataFrame, by: Sequence[str]) -> int:
    return df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


def _is_positive(label: str | None) -> Column:
    hit = (F.col(label) == 1).cast("bigint") if label else F.lit(0).cast("bigint")
    return hit.alias("is_pos")


def _value_table(df, columns, label, by) -> DataFrame:
    cells = {c: F.col(c).cast("double") + F.lit(0.0) for c in columns}
    return (
        long_form(df, cells, [*[F.col(b) for b in by], _is_positive(label)])
        .where("value IS NOT NULL")
        .groupBy(*by, "feature", "value")
        .agg(F.count("*").alias("n"), F.sum("is_pos").alias("pos"))
    )


def _dealt_value_table(df, columns, label, by) -> DataFrame:
    """As ``_value_table``; an explode, unlike an unpivot, keeps how the rows are dealt."""
    cells = unpivot_structs(columns, lambda c: [(F.col(c).cast("double") + F.lit(0.0)).alias("value")])
    return (
        df.select(*by, _is_positive(label), cells.alias("cell"))
        .where("cell.value IS NOT NULL")
        .groupBy(*by, "cell.feature", "cell.value")
        .agg(F.count("*").alias("n"), F.sum("is_pos").alias("pos"))
    )


def _bucketed_value_table(df, columns, label, by, edges) -> DataFrame:
    def cell(c: str) -> list[Column]:
        return [
            F.col(f"{c}__bucket").cast("int").alias("bucket"),
            (F.col(c).cast("double") + F.lit(0.0)).alias("value"),
        ]

    return (
        with_buckets(df, edges)
        .select(*by, _is_positive(label), unpivot_structs(columns, cell).alias("cell"))
        .where("cell.value IS NOT NULL")
        .groupBy(*by, "cell.feature", "cell.bucket", "cell.value")
        .agg(F.count("*").alias("n"), F.sum("is_pos").alias("pos"))
    )


def _below(column: str, group: Sequence[str]) -> Column:
    """Running sum over the values before the current one."""
    window = Window.partitionBy(*group).orderBy("value")
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(column).over(upto) - F.col(column)


def _counts_in_one_bucket(values: DataFrame, by: Sequence[str]) -> DataFrame:
    """A group has fewer than 2 x ROWS_PER_BUCKET values here: one window each."""
    group = [*by, "feature"]
    whole = Window.partitionBy(*group)
    return values.withColumns(
        {
            "n_below": _below("n", group),
            "pos_below": _below("pos", group),
            "n_all": F.sum("n").over(whole),
            "pos_all": F.sum("pos").over(whole),
        }
    )


def _counts_over_buckets(values: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts inside buckets plus totals of the buckets before.

    The window and the join share one partitioning on (by, feature, bucket); the
    table of bucket totals has at most one row per bucket.
    """
    group = [*by, "feature"]
    bucket = [*group, "bucket"]
    running = Window.partitionBy(*group).orderBy("bucket")
    whole = Window.partitionBy(*group)
    totals = (
        values.groupBy(*bucket)
        .agg(F.sum("n").alias("bucket_n"), F.sum("pos").alias("bucket_pos"))
        .select(
            *bucket,
            (F.sum("bucket_n").over(running) - F.col("bucket_n")).alias("n_before"),
            (F.sum("bucket_pos").over(running) - F.col("bucket_pos")).alias("pos_before"),
            F.sum("bucket_n").over(whole).alias("n_all"),
            F.sum("bucket_pos").over(whole).alias("pos_all"),
        )
    )
    return (
        values.withColumns({"n_in": _below("n", bucket), "pos_in": _below("pos", bucket)})
        .join(totals, bucket)
        .withColumns(
            {
                "n_below": F.col("n_before") + F.col("n_in"),
                "pos_below": F.col("pos_before") + F.col("pos_in"),
            }
        )
        .drop("n_in", "pos_in", "n_before", "pos_before", "bucket")
    )


def twice_rank() -> Column:
    """Twice the mean rank, a whole number."""
    return (2 * F.col("n_below") + F.col("n") + 1).cast("decimal(19,0)")


def average_rank() -> Column:
    """Mean rank (1-based) of the rows tied at a value of ``running_counts``."""
    return F.col("n_below") + (F.col("n") + 1) / F.lit(2.0)
