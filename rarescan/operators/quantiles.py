"""Exact order statistics without sorting or shuffling the table.

``percentile`` keeps every distinct value of a column in one hash map, which
is fine for a bounded number of rows only.  Beyond that bound we narrow down:
a mergeable sketch brackets the wanted rank, one counting pass says on which
side of the bracket it lies, and so on until few enough rows are left inside.
Each round is one scan with a one-row aggregate, and divides the rows inside
by some thousands, so three or four rounds cover any table.  The sketch only
steers; the counts make the result exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarescan.functions.columns import long_form

# Values the plain aggregate may hold in memory over all columns ...
SMALL_CELLS = 10_000_000
# ... and per column at the end of the narrowing.
SMALL_ROWS = 50_000
SKETCH_ACCURACY = 10_000
# Aggregates per job; wider jobs only make code generation slower.
AGGREGATES_PER_JOB = 400
# Hash aggregation of object states stays in memory up to this many groups.
GROUPS_PER_JOB = 100


@dataclass
class _Wanted:
    """The value at ``rank`` (0-based) of ``column``, known to lie in (low, high)."""

    slot: tuple
    column: Column
    rank: int
    inside: int
    low: float | None = None
    high: float | None = None
    base: int = 0  # rows at or below ``low``
    value: float | None = None

    def between(self, low, high) -> Column:
        ok = self.column.isNotNull()
        if low is not None:
            ok = ok & (self.column > F.lit(low))
        if high is not None:
            ok = ok & (self.column < F.lit(high))
        return ok

    @property
    def interval(self) -> tuple:
        return (self.slot, self.low, self.high)

    def inner(self) -> Column:
        return F.when(self.between(self.low, self.high), self.column)


def _one_row(df: DataFrame, aggregates: list[Column]) -> list:
    """Run single-row aggregates, in a few jobs when there are very many."""
    out: list = []
    for start in range(0, len(aggregates), AGGREGATES_PER_JOB):
        chunk = aggregates[start : start + AGGREGATES_PER_JOB]
        out.extend(df.agg(*[a.alias(f"a{i}") for i, a in enumerate(chunk)]).first())
    return out


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _narrow(df: DataFrame, open_: list[_Wanted], accuracy: int) -> None:
    """One sketch pass and one counting pass; shrinks or settles every entry.

    Entries of one column and interval share a sketch, and neighbouring ranks
    share a bracket.
    """
    shares: dict[tuple, list[float]] = {}
    own_share: list[tuple[tuple, float, float]] = []
    for w in open_:
        at = (w.rank - w.base) / max(1, w.inside - 1) * accuracy
        ends = [
            max(0.0, (math.floor(at) - 2) / accuracy),
            min(1.0, (math.ceil(at) + 2) / accuracy),
        ]
        sketch = shares.setdefault(w.interval, [])
        sketch.extend(e for e in ends if e not in sketch)
        own_share.append((w.interval, *ends))
    inner = {w.interval: w.inner() for w in open_}
    rows = _one_row(
        df, [F.percentile_approx(inner[i], ends, accuracy) for i, ends in shares.items()]
    )
    value_at = {
        (i, end): value
        for (i, ends), values in zip(shares.items(), rows)
        for end, value in zip(ends, values)
    }
    brackets = [(value_at[i, lo], value_at[i, hi]) for i, lo, hi in own_share]
    counts: dict[tuple, Column] = {}
    for w, (a, b) in zip(open_, brackets):
        counts[w.interval, a, "<"] = _count_if(w.between(w.low, a))
        counts[w.interval, a, "="] = _count_if(w.column == F.lit(a))
        counts[w.interval, a, b] = _count_if(w.between(a, b))
        counts[w.interval, b, "="] = _count_if(w.column == F.lit(b))
    n = dict(zip(counts, _one_row(df, list(counts.values()))))
    for w, (a, b) in zip(open_, brackets):
        below, at_a = n[w.interval, a, "<"], n[w.interval, a, "="]
        middle, at_b = (0, 0) if a == b else (n[w.interval, a, b], n[w.interval, b, "="])
        left = w.rank - w.base
        if left < below:
            w.high, w.inside = a, below
        elif left < below + at_a:
            w.value = a
        elif left < below + at_a + middle:
            w.low, w.high, w.base, w.inside = a, b, w.base + below + at_a, middle
        elif left < below + at_a + middle + at_b:
            w.value = b
        else:
            above = below + at_a + middle + at_b
            w.low, w.base, w.inside = b, w.base + above, w.inside - above


def _settle(df: DataFrame, wanted: list[_Wanted], small: int, accuracy: int) -> None:
    open_ = [w for w in wanted if w.value is None and w.inside > small]
    while open_:
        _narrow(df, open_, accuracy)
        open_ = [w for w in open_ if w.value is None and w.inside > small]
    rest = [w for w in wanted if w.value is None]
    if not rest:
        return
    # At most ``small`` rows per entry are left: a plain exact aggregate.
    sorted_rows: dict[tuple, list[_Wanted]] = {}
    for w in rest:
        sorted_rows.setdefault(w.interval, []).append(w)
    groups = list(sorted_rows.values())
    picks = []
    for group in groups:
        inside = F.sort_array(F.collect_list(group[0].inner()))
        picks.append(F.array(*[F.element_at(inside, w.rank - w.base + 1) for w in group]))
    for group, values in zip(groups, _one_row(df, picks)):
        for w, value in zip(group, values):
            w.value = value


def _interpolate(position: float, lower: float, upper: float) -> float:
    below, above = math.floor(position), math.ceil(position)
    if below == above or lower == upper:
        return lower
    return (above - position) * lower + (position - below) * upper


def _plain_quantiles(df: DataFrame, pairs: list, probs: list[float]) -> dict:
    """One group per column, so columns are merged by different tasks."""
    found: dict[int, list[float]] = {}
    for start in range(0, len(pairs), GROUPS_PER_JOB):
        chunk = range(start, min(len(pairs), start + GROUPS_PER_JOB))
        rows = (
            long_form(df, {str(i): pairs[i][1].cast("double") for i in chunk})
            .where("value IS NOT NULL")
            .groupBy("feature")
            .agg(F.percentile("value", probs).alias("q"))
        )
        found.update({int(r["feature"]): list(r["q"]) for r in rows.collect()})
    return {slot: found.get(i, [None] * len(probs)) for i, (slot, _) in enumerate(pairs)}


def exact_quantiles(
    df: DataFrame,
    columns: Iterable[str | tuple[object, Column]],
    probs: Sequence[float],
    counts: Sequence[int] | None = None,
    small_cells: int = SMALL_CELLS,
    small: int = SMALL_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[object, list[float | None]]:
    """Linear-interpolation quantiles of several columns, nulls skipped.

    ``columns`` holds names, or (slot, expression) pairs; the result maps each
    name or slot to one value per probability (``None`` for an empty column).
    The driver receives one number per column and probability.  ``counts`` are
    the non-null rows per column, where the caller has them.
    """
    pairs = [(c, F.col(c).cast("double")) if isinstance(c, str) else c for c in columns]
    probs = list(probs)
    if not pairs:
        return {}
    few = (sum(counts) if counts else df.count() * len(pairs)) <= small_cells
    if not few and not counts:
        counts = _one_row(df, [F.count(c) for _, c in pairs])
        few = sum(counts) <= small_cells
    if few:
        return _plain_quantiles(df, pairs, probs)
    wanted: dict[tuple, _Wanted] = {}
    for (slot, column), n in zip(pairs, counts):
        for p in probs if n else ():
            for rank in {math.floor(p * (n - 1)), math.ceil(p * (n - 1))}:
                wanted[slot, rank] = _Wanted((slot,), column, rank, n)
    _settle(df, list(wanted.values()), small, accuracy)
    out: dict[object, list[float | None]] = {}
    for (slot, _), n in zip(pairs, counts):
        out[slot] = [
            _interpolate(
                p * (n - 1),
                wanted[slot, math.floor(p * (n - 1))].value,
                wanted[slot, math.ceil(p * (n - 1))].value,
            )
            if n
            else None
            for p in probs
        ]
    return out


def rank_values(
    df: DataFrame,
    targets: Sequence[tuple[object, Column, int, int]],
    small: int = SMALL_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[object, float]:
    """Exact values at given 0-based ranks: (slot, expression, rank, row count)."""
    wanted = [_Wanted((slot,), column, rank, n) for slot, column, rank, n in targets]
    _settle(df, wanted, small, accuracy)
    return {w.slot[0]: w.value for w in wanted}
