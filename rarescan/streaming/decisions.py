"""Decisions on a stream of scored rows.

The batch rules run unchanged on the stream.  Decisions are appended one batch
folder at a time; running totals come from a streaming aggregate.  Replaying a
batch after a failure overwrites its own folder, so nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarescan.operators.decisions import outcome
from rarescan.sources import versions
from rarescan.sources.tables import read_table

BATCH = "batch"


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A folder (or glob) of parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def write_decisions(
    stream: DataFrame,
    decide: Callable[[DataFrame], DataFrame],
    label: str,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
):
    """Start a query that decides every row and appends it to ``out``.

    ``decide`` adds a ``decision`` column; ``outcome`` is added here.
    """
    decided = decide(stream).withColumn("outcome", outcome(label))

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")

    return (
        decided.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def write_running_totals(
    stream: DataFrame,
    decide: Callable[[DataFrame], DataFrame],
    label: str,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
):
    """Start a query that keeps rows per outcome up to date in ``out``.

    The state is one row per outcome.
    """
    totals = (
        decide(stream)
        .withColumn("outcome", outcome(label))
        .groupBy("outcome")
        .agg(F.count("*").alias("n"))
    )

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(out)

    return (
        totals.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def write_versions(totals: DataFrame, out: str, checkpoint: str, trigger: dict | None = None):
    """Start a query that publishes each state of a streaming aggregate as the newest version of ``out``.

    ``totals`` is small, as outcome counts or a cost report.  A reader (``read_newest``) sees the totals before
    or after a batch, never none; a replayed batch publishes what the state gives, which is the same.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        versions.publish_table(batch.coalesce(1), out)

    return (
        totals.writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_newest(spark: SparkSession, out: str) -> DataFrame:
    return read_table(spark, versions.newest(spark, out))


def finished(query) -> None:
    """Wait for an availableNow query; its error, if any, is raised here."""
    query.awaitTermination()
