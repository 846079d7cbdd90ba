"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a maximal run of anything but ASCII space, \t, \n, \v, \f, \r.
WORD_GAP = r"[\x20\x09-\x0D]+"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast: further columns, whatever their names, cannot clash."""
    return df.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in types.items()))


def bounded_batches(df: DataFrame, limit: str = "16m") -> DataFrame:
    """Cap the bytes of an Arrow batch, so that long texts cannot fill a Python worker."""
    df.sparkSession.conf.set(ARROW_BYTES, limit)
    return df


def free_unused() -> None:
    """Give memory that is free again back to the system: a Python worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it often, also inside lambda functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text (null: none), see WORD_GAP."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
