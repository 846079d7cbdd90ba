"""Nearest neighbours of one class along a column, over blocks of its sorted places.

Places of a column are dealt into ranges, packed, in one shuffle; a block is a range,
sorted.  A table of what each block holds at its ends, a few numbers per block and
class, tells a block the neighbours beyond them and how many places lie before it, so
a block counts alone, but for intervals that end in another block: those ends, packed
too, are looked up there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarescan.operators.ranks import ROWS_PER_BUCKET, bucket_edges
from rarescan.sources.shared import discard, materialize

DEALT_CELLS = 2_000_000  # that a task gathers before it packs them
CLOSED, OPEN, ASKED = 0, 1, 2

DEALT = "feature int, bucket int, places binary, classes binary, twins binary"
BLOCKS = (
    "feature int, bucket int, places binary, classes binary, twins binary, n bigint, "
    "first array<array<bigint>>, last array<array<bigint>>"
)
FOUND = (
    "kind int, feature int, bucket int, home int, at binary, classes binary, twins binary, numbers binary, "
    "sign int, class int, within bigint, n bigint, twin bigint"
)
ANSWERS = "kind int, feature int, home int, at binary, classes binary, twins binary, numbers binary"
COUNTS = "feature int, class int, within bigint, n bigint, twin bigint"
ONE = -1  # of a row that has no twin


def _table(rows: list[dict], spec: str) -> pa.Table:
    kinds = {
        "int": pa.int32(),
        "bigint": pa.int64(),
        "binary": pa.binary(),
        "array<array<bigint>>": pa.list_(pa.list_(pa.int64())),
    }
    fields = [part.split() for part in spec.split(", ")]
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])
    return pa.Table.from_pylist(rows, schema)


def _pack_twins(twins: np.ndarray) -> bytes:
    return twins.tobytes() if (twins != ONE).any() else b""


def _twins(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, np.int64) if data else np.full(count, ONE)


def _joined(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), dtype)


def _bucket_of(places: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, places.astype(np.float64), "right")


def _deal(batches: Iterator[pa.RecordBatch], edges: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        classes, twins, places = (np.concatenate(part) for part in zip(*held))
        rows = []
        for feature, cuts in enumerate(edges):
            own = places[:, feature]
            bucket = _bucket_of(own, cuts)
            order = np.argsort(bucket, kind="stable")
            numbers, starts = np.unique(bucket[order], return_index=True)
            for number, chosen in zip(numbers.tolist(), np.split(order, starts[1:])):
                rows.append(
                    {
                        "feature": feature,
                        "bucket": number,
                        "places": own[chosen].tobytes(),
                        "classes": classes[chosen].tobytes(),
                        "twins": _pack_twins(twins[chosen]),
                    }
                )
        yield from _table(rows, DEALT).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        places = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(edges))
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), places))
        size += places.size
        if size >= DEALT_CELLS:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def _block(table: pa.Table, classes: int, k: int) -> pa.Table:
    """A range's places in order, and the first and last ``k`` of each class."""
    places, of = _joined(table, "places", np.int64), _joined(table, "classes", np.int32)
    parts = zip(table["twins"].to_pylist(), table["places"].to_pylist())
    twins = np.concatenate([_twins(twin, len(data) // 8) for twin, data in parts])
    order = np.argsort(places, kind="stable")
    places, of, twins = places[order], of[order], twins[order]
    own = [places[of == c] for c in range(classes)]
    row = {
        "feature": table["feature"][0].as_py(),
        "bucket": table["bucket"][0].as_py(),
        "places": places.tobytes(),
        "classes": of.tobytes(),
        "twins": _pack_twins(twins),
        "n": len(places),
        "first": [p[:k].tolist() for p in own],
        "last": [p[-k:].tolist() for p in own],
    }
    return _table([row], BLOCKS)


class Ends:
    """What a column's blocks hold at their ends."""

    def __init__(self, edges: np.ndarray, blocks: list, classes: int, k: int):
        self.edges = edges
        sizes = np.zeros(len(edges) + 1, np.int64)
        for block in blocks:
            sizes[block["bucket"]] = block["n"]
        self.sizes, self.before = sizes, np.cumsum(sizes) - sizes  # by bucket
        blocks = sorted(blocks, key=lambda block: block["bucket"])
        # by bucket and class, the k nearest places of other blocks
        self.lower = self._beyond(blocks, "last", classes, lambda new, old: (old + new)[-k:])
        self.upper = self._beyond(blocks[::-1], "first", classes, lambda new, old: (new + old)[:k])

    @staticmethod
    def _beyond(blocks, name, classes, add) -> dict[int, list[list[int]]]:
        out, seen = {}, [[] for _ in range(classes)]
        for block in blocks:
            out[block["bucket"]] = seen
            seen = [add(new, old) for new, old in zip(block[name], seen)]
        return out


def _radius(own: np.ndarray, lower: list[int], upper: list[int], k: int) -> np.ndarray:
    """Distance to the k-th nearest of the class: the tightest run of k + 1 places around each."""
    line = np.concatenate([np.array(lower, np.int64), own, np.array(upper, np.int64)])
    at = np.arange(len(own)) + len(lower)
    out = np.full(len(own), np.iinfo(np.int64).max)
    for left in range(k + 1):
        start = at - left
        # a run that sticks out at an end does not count
        whole = (start >= 0) & (start + k < len(line))
        start = start[whole]
        out[whole] = np.minimum(out[whole], np.maximum(own[whole] - line[start], line[start + k] - own[whole]))
    return out


def _histogram(feature: int, of: np.ndarray, within: np.ndarray, twins: np.ndarray) -> list[dict]:
    rows = []
    alone = twins == ONE
    for c in np.unique(of[alone]).tolist():
        values, counts = np.unique(within[alone & (of == c)], return_counts=True)
        rows += [
            {"feature": feature, "class": c, "within": w, "n": n}
            for w, n in zip(values.tolist(), counts.tolist())
        ]
    for c, w, twin in zip(of[~alone].tolist(), within[~alone].tolist(), twins[~alone].tolist()):
        rows.append({"feature": feature, "class": c, "within": w, "n": 1, "twin": twin})
    return rows


def _count(block: dict, ends: Ends, nearest: Sequence[int]) -> list[dict]:
    """Counts of the places whose interval ends in the block; what the others have and ask for."""
    feature, bucket = block["feature"], block["bucket"]
    places, of = np.frombuffer(block["places"], np.int64), np.frombuffer(block["classes"], np.int32)
    twins = _twins(block["twins"], len(places))
    reach = np.zeros(len(places), np.int64)
    for c, k in enumerate(nearest):
        mine = of == c
        own = places[mine]
        if len(own):
            radius = _radius(own, ends.lower[bucket][c], ends.upper[bucket][c], k)
            reach[mine] = np.maximum(radius, 1) - 1
    within, opened, asked = np.zeros(len(places), np.int64), np.zeros(len(places), bool), []
    for sign, ask in ((1, places + reach), (-1, places - reach - 1)):
        target = _bucket_of(ask, ends.edges)
        here = target == bucket
        within += sign * ends.before[target]
        within[here] += sign * np.searchsorted(places, ask[here], "right")
        away = ~here & (ends.sizes[target] > 0)
        opened |= away
        asked.append((sign, ask, target, away))
    rows = [r | {"kind": CLOSED} for r in _histogram(feature, of[~opened], within[~opened], twins[~opened])]
    number = np.cumsum(opened) - 1
    if opened.any():
        rows.append(
            {
                "kind": OPEN, "feature": feature, "home": bucket, "classes": of[opened].tobytes(),
                "twins": _pack_twins(twins[opened]), "numbers": within[opened].tobytes(),
            }
        )
    for sign, ask, target, away in asked:
        for there in np.unique(target[away]).tolist():
            chosen = away & (target == there)
            rows.append(
                {
                    "kind": ASKED, "feature": feature, "bucket": there, "home": bucket, "sign": sign,
                    "at": number[chosen].tobytes(), "numbers": ask[chosen].tobytes(),
                }
            )
    return rows


def _answer(asked: pa.Table, block: pa.Table) -> pa.Table:
    if not asked.num_rows:
        return _table([], ANSWERS)
    places = _joined(block, "places", np.int64)
    rows = []
    for row in asked.to_pylist():
        found = np.searchsorted(places, np.frombuffer(row["numbers"], np.int64), "right")
        rows.append(
            {
                "kind": ASKED, "feature": row["feature"], "home": row["home"], "at": row["at"],
                "numbers": (row["sign"] * found.astype(np.int64)).tobytes(),
            }
        )
    return _table(rows, ANSWERS)


def _close(table: pa.Table) -> pa.Table:
    """The counts of a block's open places: their own and all answers."""
    rows = sorted(table.to_pylist(), key=lambda row: row["kind"])
    (own, *answers) = rows
    within = np.frombuffer(own["numbers"], np.int64).copy()
    for row in answers:
        np.add.at(within, np.frombuffer(row["at"], np.int64), np.frombuffer(row["numbers"], np.int64))
    of, twins = np.frombuffer(own["classes"], np.int32), _twins(own["twins"], len(within))
    return _table(_histogram(own["feature"], of, within, twins), COUNTS)


def _edges(df: DataFrame, cells: Sequence[Column], rows: int, rows_per_bucket: int) -> list[np.ndarray]:
    buckets = rows // rows_per_bucket
    if buckets <= 1:
        return [np.zeros(0)] * len(cells)
    names = [f"place{i}" for i in range(len(cells))]
    edges = bucket_edges(df.select(*[c.alias(n) for c, n in zip(cells, names)]), names, buckets)
    return [np.array(edges[n], np.float64) for n in names]


def neighbor_counts(
    df: DataFrame,
    cells: Sequence[Column],
    class_of: Column,
    twin_of: Column,
    sizes: Sequence[int],
    k: int,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """(feature, class, within, n): how many rows of a class have ``within`` rows nearer than their k-th of it.

    ``cells`` are whole numbers, one per feature, ``class_of`` is 0, 1, ... for classes of ``sizes`` rows.
    Rows of one ``twin_of`` (null: none) and class are one row, of the sum of their counts.
    """
    edges = _edges(df, cells, sum(sizes), rows_per_bucket)
    nearest = [min(k, n - 1) for n in sizes]
    rows = df.select(
        class_of.cast("int").alias("class"),
        F.coalesce(twin_of.cast("bigint"), F.lit(ONE)).alias("twin"),
        F.array(*cells).cast("array<bigint>").alias("cells"),
    )
    dealt = rows.mapInArrow(lambda batches: _deal(batches, edges), DEALT)
    gathered = dealt.groupBy("feature", "bucket").applyInArrow(lambda t: _block(t, len(sizes), k), BLOCKS)
    blocks = materialize(gathered, "blocks", blocks=True)
    # a few numbers per block and class
    held: list[list] = [[] for _ in cells]
    for row in blocks.select("feature", "bucket", "n", "first", "last").collect():
        held[row["feature"]].append(row.asDict())
    ends = [Ends(cuts, own, len(sizes), k) for cuts, own in zip(edges, held)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                (block,) = batch.slice(at, 1).to_pylist()
                yield from _table(_count(block, ends[block["feature"]], nearest), FOUND).to_batches()

    packed = blocks.select("feature", "bucket", "places", "classes", "twins")
    found = materialize(packed.mapInArrow(count, FOUND), "counted", ("kind",), blocks=True)
    of_kind = lambda kind: found.where(F.col("kind") == kind)
    asked = of_kind(ASKED).select("feature", "bucket", "home", "at", "numbers", "sign")
    searched = blocks.select("feature", "bucket", "places")
    answers = asked.groupBy("feature", "bucket").cogroup(searched.groupBy("feature", "bucket"))
    answers = answers.applyInArrow(_answer, ANSWERS)
    names = [part.split()[0] for part in ANSWERS.split(", ")]
    both = of_kind(OPEN).select(*names).unionByName(answers)
    closed = both.groupBy("feature", "home").applyInArrow(_close, COUNTS)
    counts = materialize(of_kind(CLOSED).select(*closed.columns).unionByName(closed), "counts")
    discard(blocks, found)
    alone = counts.where("twin IS NULL").drop("twin")
    twins = counts.where("twin IS NOT NULL").groupBy("feature", "class", "twin")
    twins = twins.agg(F.sum("within").alias("within"), F.lit(1).cast("bigint").alias("n"))
    return alone.unionByName(twins.drop("twin"))
