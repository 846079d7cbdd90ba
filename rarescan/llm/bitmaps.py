"""Sets of 64-bit hashes as bitmaps that every task gets.

A bitmap holds every hash put in, and may hold more: it only spares work, and no
result depends on it.  Its size follows the input, up to MOST_BITS; beyond, it
filters less.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

LEAST_BITS, MOST_BITS = 1 << 18, 1 << 28
LEAST_RANGES, MOST_RANGES = 64, 1 << 20
RANGE_BYTES = 1 << 26  # of text per range
FLUSH = 1 << 21  # hashes that a task gathers before it sends them
MIX = np.uint64(0x9E3779B97F4A7C15)


class Bitmap:
    """Bits by the leading bits of a hash."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.shift = np.uint64(64 - (len(bits) * 8).bit_length() + 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> self.shift).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def bits_for(count: int) -> int:
    """A power of two, at least eight times the count within the limits."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (8 * max(1, count) - 1).bit_length()))


def mixed(keys: np.ndarray) -> np.ndarray:
    """Keys of any kind (longs) as evenly spread hashes."""
    h = keys.view(np.uint64) * MIX
    return (h ^ h >> np.uint64(32)) * MIX


def key_bitmap(keys: DataFrame, count: int) -> Broadcast:
    """A broadcast Bitmap of the ``mixed`` longs of a frame of one column."""
    size = bits_for(count)

    def run(batches):
        bits = None
        for batch in batches:
            bits = np.zeros(size, bool) if bits is None else bits
            hashes = mixed(batch.column(0).to_numpy(zero_copy_only=False))
            bits[hashes >> np.uint64(64 - size.bit_length() + 1)] = True
        if bits is not None:
            packed = np.packbits(bits, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(packed, 1)], pa.binary())], ["bits"])

    total = np.zeros(size // 8, np.uint8)
    for row in keys.repartition(4).mapInArrow(run, "bits binary").collect():  # size bits each
        total |= np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return keys.sparkSession.sparkContext.broadcast(Bitmap(total))


def occurrence_bitmaps(
    texts: DataFrame,
    hashes_of: Callable[[str | None], np.ndarray],
    first: Broadcast,
    total_bytes: int,
    expected: int,
    levels: tuple[int, ...] = (2,),
) -> Broadcast:
    """For each level a Bitmap of the hashes that so many texts or more have.

    ``texts`` has (key, text); rows whose key is not in ``first`` are left out.
    The hash space is cut into ranges, counted apart: a task sends per range the 32
    bits after the range's own of each distinct hash, with its count if above one;
    a range's sums set its slice of the bitmaps.
    """
    size = bits_for(expected)
    ranges = LEAST_RANGES
    while ranges * RANGE_BYTES < total_bytes and ranges < min(MOST_RANGES, size // 8):
        ranges *= 2
    lead = ranges.bit_length() - 1
    slice_bits = size // ranges

    def sent(waiting: list[np.ndarray]) -> pa.RecordBatch:
        hashes, counts = np.unique(np.concatenate(waiting), return_counts=True)
        cuts = np.searchsorted(hashes >> np.uint64(64 - lead), np.arange(ranges + 1, dtype=np.uint64))
        short = (hashes >> np.uint64(32 - lead)).astype(np.uint32)
        rows = []
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            names, n = short[cuts[i] : cuts[i + 1]], counts[cuts[i] : cuts[i + 1]]
            many = n > 1
            rows.append(
                (i, names[~many].tobytes(), names[many].tobytes(), n[many].astype(np.uint32).tobytes())
            )
        columns = [list(c) for c in zip(*rows, strict=True)]
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["range", "one", "many", "n"]
        )

    def collect(batches):
        known = first.value
        waiting: list[np.ndarray] = []
        gathered = 0
        for batch in batches:
            wanted = np.flatnonzero(known.has(mixed(batch.column(0).to_numpy(zero_copy_only=False))))
            for text in batch.column(1).take(pa.array(wanted)).to_pylist():
                hashes = hashes_of(text)
                if len(hashes):
                    waiting.append(hashes)
                    gathered += len(hashes)
                if gathered >= FLUSH:
                    yield sent(waiting)
                    waiting, gathered = [], 0
        if waiting:
            yield sent(waiting)

    def count(table: pa.Table) -> pa.Table:
        one, many, n = (
            [np.frombuffer(b, np.uint32) for b in table[c].to_pylist()] for c in ("one", "many", "n")
        )
        names = np.concatenate([*one, *many])
        weights = np.concatenate([np.ones(sum(map(len, one)), np.uint32), *n])
        order = np.argsort(names, kind="stable")
        names, weights = names[order], weights[order]
        starts = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        sums = np.add.reduceat(weights, starts)
        out = {"range": table["range"][:1]}
        for k, level in enumerate(levels):
            bits = np.zeros(slice_bits, bool)
            often = names[starts[sums >= level]].astype(np.uint64)
            bits[(often * np.uint64(slice_bits)) >> np.uint64(32)] = True
            out[f"b{k}"] = [np.packbits(bits, bitorder="little").tobytes()]
        return pa.table(out)

    rows = bounded_batches(texts.select("key", "text")).mapInArrow(
        collect, "range int, one binary, many binary, n binary"
    )
    fields = ", ".join(f"b{k} binary" for k in range(len(levels)))
    whole = [np.zeros(size // 8, np.uint8) for _ in levels]
    counted = rows.groupBy("range").applyInArrow(count, f"range int, {fields}")
    for row in counted.collect():  # size bits per level in all
        at = row["range"] * slice_bits // 8
        for k, bits in enumerate(whole):
            bits[at : at + slice_bits // 8] = np.frombuffer(row[f"b{k}"], np.uint8)
    return texts.sparkSession.sparkContext.broadcast([Bitmap(b) for b in whole])


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, ord, text, class, sha256, key) of rows (doc_id, text): ``class`` names equal texts.

    ``ord`` puts a null doc_id last; ``key`` tells a row's class and place in it.
    """
    rows = docs.select(
        "doc_id",
        F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("ord"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("sha256", F.sha2("text", 256))
    rows = rows.withColumn("class", F.unhex(F.substring("sha256", 1, 32)))
    return rows.withColumn("key", F.xxhash64("ord", "class"))


def first_of_class(facts: DataFrame) -> tuple[DataFrame, Broadcast]:
    """(class, first_ord) of written rows, and a bitmap of the keys of those first rows."""
    classes = facts.groupBy("class").agg(F.min("ord").alias("first_ord"))
    keys = classes.select(F.xxhash64("first_ord", "class").alias("key"))
    return classes, key_bitmap(keys, facts.count())
