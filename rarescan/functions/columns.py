"""Column expressions shared by the operators.  All run inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 13 hex digits of md5 = 52 bits: a double holds the value exactly.
HASH_DIGITS = 13
HASH_BITS = 4 * HASH_DIGITS
HASH_SPACE = 1 << HASH_BITS


def keyed_hash(key: str | Column, salt: str) -> Column:
    """Uniform integer in [0, 2^52) that depends on key and salt only.

    Stateless: the same row gets the same number on any cluster, in any
    partitioning and after any retry.
    """
    column = F.col(key) if isinstance(key, str) else key
    text = F.concat(column.cast("string"), F.lit(f":{salt}"))
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("bigint")


def hash_cut(fraction: float) -> int:
    """Rows whose hash is below this number make up ``fraction`` in expectation."""
    return int(fraction * HASH_SPACE)


def clip(column: Column, low: float, high: float) -> Column:
    """Clip to [low, high]; null stays null (least/greatest alone would drop it)."""
    return F.when(column.isNotNull(), F.greatest(F.least(column, F.lit(high)), F.lit(low)))


def ratio0(top: Column, bottom: Column) -> Column:
    """top / bottom, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def flag(condition: Column) -> Column:
    """0/1 byte; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("byte")


def long_form(df: DataFrame, cells: Mapping[str, Column], keep: Sequence[Column] = ()) -> DataFrame:
    """(keep..., feature, value): one row per cell.  All cells have one type.

    The aggregate that follows combines rows before any shuffle.
    """
    kept = df.select(*keep).columns if keep else []
    wide = df.select(*keep, *[cell.alias(name) for name, cell in cells.items()])
    return wide.unpivot(kept, list(cells), "feature", "value")


def unpivot_structs(columns, build) -> Column:
    """As ``long_form``, for several fields per column: ``build(name)`` returns them."""
    return F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), *build(c)) for c in columns]))
