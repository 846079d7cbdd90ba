"""Exact n-gram Jaccard join by vertical partitioning, and its connected components.

A document's set is its distinct word n-grams as 64-bit hashes.  Equal texts are one
class and equal sets one node from the start, so copies never meet in a join.  All
sets are cut along one global order of the n-grams: those of one text, then those of
a few, then those of many, each by hash.

- The first fragment of each set (its prefix) must hold a common n-gram of any pair
  similar enough; its n-grams that other texts have too are the posting lists.
- Contraction: on some places of the prefixes, each list's members meet a few leaders only,
  drawn by hash for each list, and keep the nearest by parity bits.  So each member of a group
  of near copies has its own choice of leaders, and the group becomes one component, whatever its size.
- The rest: lists that still touch several components give the pairs between
  different components. Sizes, places and parity bits (one flip per n-gram, so two sets
  differ in at least as many n-grams as bits) rule most others out inside the join.
- Pairs are verified fragment by fragment: the other fragments (ranges of the
  hash order) are joined on (node, fragment), overlaps are counted apart, and summed
  per pair.

How many texts have an n-gram is counted over all texts, in ranges of the hash space, and
goes to the tasks as bitmaps of a bounded size, as do the nodes to verify.  A full
bitmap only filters less; no result depends on it.

Defined cases: null or empty text gives an empty set, linked with nothing (its
component is its own doc_id); fewer words than n are one n-gram; repeated rows
belong to one node; a null doc_id takes part, and is a component's id only
if it has no other; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache, partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ..sources.shared import discard, materialize
from .bitmaps import Bitmap, first_of_class, key_bitmap, keyed, mixed, occurrence_bitmaps
from .common import bounded_batches, narrow, unused

WORDS = 4
PERCENT = 85
FREQUENT = 30  # texts from which on an n-gram goes to the end of the order
TURNS = 1  # of contraction
FIRST, LAST = 4, 12  # n-grams of a prefix, from its start and its end, whose lists have leaders
DRAWS = 8  # leaders of a list
KEPT = 3  # leaders that a node keeps in a turn
FRAGMENTS = 8
LARGE_SET = 1 << 16  # n-grams above which a set's fragments are rows of their own
SIGNATURE = 8  # longs of parity bits per set
BYTES_PER_SHARED = 48  # of text, for the size of the bitmaps
CHUNK = 1 << 22
SPACE = re.compile(rb"[\x20\x09-\x0D]")
MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0x2127599BF4325C37)


# ---- sets -------------------------------------------------------------------


@lru_cache(maxsize=1)
def _spaces() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


@lru_cache(maxsize=2)
def _powers(count: int) -> np.ndarray:
    """Powers of BASE modulo 2^64."""
    steps = np.full(count, BASE, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _hashes_of(data: np.ndarray) -> np.ndarray:
    inside = ~_spaces()[data]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.uint64)
    first = np.concatenate([[True], np.diff(at) > 1])
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(at)))
    local = np.arange(len(at)) - np.repeat(starts, lengths)
    power = _powers(1 << max(8, int(lengths.max()).bit_length()))
    terms = (data[at].astype(np.uint64) + np.uint64(1)) * power[local]
    h = np.add.reduceat(terms, starts) + lengths.astype(np.uint64)
    h ^= h >> np.uint64(31)
    h *= MIX
    return h ^ h >> np.uint64(29)


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word of a whole text, A-Z lowered, piece by piece."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    parts, at = [], 0
    while at < len(data):
        end = len(data)
        if end - at > CHUNK:
            gap = SPACE.search(data, at + CHUNK)  # a piece ends at white space
            end = gap.start() if gap else end
        parts.append(_hashes_of(np.frombuffer(data, np.uint8)[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def ngrams(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct n-gram hashes of a whole text."""
    w = word_hashes(text)
    if not len(w):
        return w
    size = min(words, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        h = (h ^ w[k : k + len(h)]) * MIX
        h ^= h >> np.uint64(32)
    return np.unique(h)


def node_of(grams: np.ndarray) -> bytes:
    return blake2b(grams.tobytes(), digest_size=16).digest()


# ---- prefixes, postings, fragments --------------------------------------------


def prefix_size(size: int, percent: int = PERCENT) -> int:
    """Of two sets that are similar enough, prefixes of this size share an n-gram."""
    return size - -(-percent * size // 100) + 1 if size else 0


def shared_prefix(grams: np.ndarray, levels: list[Bitmap], percent: int):
    """The prefix's n-grams that two texts or more have, and their places in the order."""
    shared = levels[0].has(grams)
    often = shared & levels[1].has(grams)
    few, many = grams[shared & ~often], grams[often]
    alone = len(grams) - len(few) - len(many)
    size = max(0, prefix_size(len(grams), percent) - alone)
    found = np.concatenate([few, many])[:size]
    return found, np.arange(alone, alone + len(found), dtype=np.int32)


def parity(grams: np.ndarray) -> np.ndarray:
    """Bits that each n-gram flips: two sets differ in at least as many n-grams as bits."""
    bits = np.bincount((grams & np.uint64(64 * SIGNATURE - 1)).astype(np.int64), minlength=64 * SIGNATURE)
    return np.packbits((bits & 1).astype(np.uint8), bitorder="little").view(np.int64)


def _lists(rows: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(kind)))


def _prefixes(texts: DataFrame, first, levels, words: int, percent: int) -> DataFrame:
    """(class, node, size, grams, places, bits) of the first row of every class."""
    names = ["class", "node", "size", "grams", "places", "bits"]

    def run(batches):
        known, bits = first.value, levels.value
        for batch in batches:
            wanted = known.has(mixed(batch.column(0).to_numpy(zero_copy_only=False)))
            at = pa.array(np.flatnonzero(wanted))
            sets = [ngrams(t, words) for t in batch.column(2).take(at).to_pylist()]
            found = [shared_prefix(s, bits, percent) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).take(at),
                    pa.array([node_of(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _lists([f[0].view(np.int64) for f in found], np.int64),
                    _lists([f[1] for f in found], np.int32),
                    _lists([parity(s) for s in sets], np.int64),
                ],
                names,
            )

    schema = (
        "class binary, node binary, size bigint, grams array<bigint>, places array<int>, bits array<bigint>"
    )
    return bounded_batches(texts.select("key", "class", "text")).mapInArrow(run, schema)


def _postings(nodes: DataFrame, *more: str) -> DataFrame:
    """(gram, place, rank, node, size, bits..., more...): one row per node and n-gram."""
    both = F.arrays_zip("grams", "places")
    bits = [F.col("bits")[i].alias(f"bits{i}") for i in range(SIGNATURE)]
    held = F.size("grams").alias("held")
    rows = nodes.select("node", "size", held, *more, *bits, F.posexplode(both).alias("rank", "both"))
    return rows.select(
        F.col("both.grams").alias("gram"), F.col("both.places").alias("place"), "rank",
        (F.col("held") - 1 - F.col("rank")).alias("left"), "node", "size",
        *(f"bits{i}" for i in range(SIGNATURE)), *more,
    )


def _flips() -> Column:
    """How many parity bits differ: no more than the pair's n-grams that only one of the two has."""
    flipped = F.lit(0)
    for i in range(SIGNATURE):
        flipped = flipped + F.bit_count(F.col(f"bits{i}_a").bitwiseXOR(F.col(f"bits{i}_b")))
    return flipped


def _near_enough(percent: int) -> Column:
    """The parity bits do not rule the pair out: it differs in few enough n-grams."""
    return (100 + percent) * _flips() <= (100 - percent) * (F.col("size_a") + F.col("size_b"))


def _fragments(texts: DataFrame, first, wanted, words: int, percent: int) -> DataFrame:
    """(node, cut, block, parts): the wanted sets, cut into FRAGMENTS ranges of the hash order.

    A set's fragments are one row (cut 1), those of a very large one a row each (cut
    FRAGMENTS); sets that may meet a very large one have both, so that any two of a pair
    have one in common.
    """
    shift = np.uint64(64 - (FRAGMENTS.bit_length() - 1))

    def run(batches):
        known, keep = first.value, wanted.value
        for batch in batches:
            at = np.flatnonzero(known.has(mixed(batch.column(0).to_numpy(zero_copy_only=False))))
            nodes, cuts, blocks, rows = [], [], [], []
            for text in batch.column(1).take(pa.array(at)).to_pylist():
                grams = ngrams(text, words)
                node = node_of(grams)
                if not keep.has(mixed(np.array([int.from_bytes(node[:7], "big")])))[0]:
                    continue
                edges = np.searchsorted(grams >> shift, np.arange(FRAGMENTS + 1, dtype=np.uint64))
                parts = np.split(grams.view(np.int64), edges[1:-1])
                if len(grams) <= LARGE_SET:
                    nodes, cuts, blocks = [*nodes, node], [*cuts, 1], [*blocks, 0]
                    rows.append(parts)
                if 100 * len(grams) > percent * LARGE_SET:
                    for n, part in enumerate(parts):
                        nodes, cuts, blocks = [*nodes, node], [*cuts, FRAGMENTS], [*blocks, n]
                        rows.append([part])
            inner = _lists([part for row in rows for part in row], np.int64)
            ends = np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(cuts, pa.int32()), pa.array(blocks, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends), inner)],
                ["node", "cut", "block", "parts"],
            )

    schema = "node binary, cut int, block int, parts array<array<bigint>>"
    rows = bounded_batches(texts.select("key", "text")).mapInArrow(run, schema)
    return rows.dropDuplicates(["node", "cut", "block"])


# ---- pairs --------------------------------------------------------------------


def _wanted(pairs: DataFrame):
    """A bitmap of the nodes of the pairs, by their first seven bytes."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    keys = nodes.select(F.conv(F.hex(F.substring("node", 1, 7)), 16, 10).cast("bigint").alias("key"))
    return key_bitmap(keys, 2 * pairs.count())


def verified(texts: DataFrame, first, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The written pairs (a, b, size_a, size_b) that are similar enough, as (a, b)."""
    if pairs.isEmpty():
        return pairs.select("a", "b")
    parts = materialize(_fragments(texts, first, _wanted(pairs), words, percent), "fragments")
    left = parts.select(F.col("node").alias("a"), "cut", "block", F.col("parts").alias("parts_a"))
    right = parts.select(F.col("node").alias("b"), "cut", "block", F.col("parts").alias("parts_b"))
    cut = F.when(F.greatest("size_a", "size_b") <= LARGE_SET, 1).otherwise(FRAGMENTS)
    overlaps = F.zip_with("parts_a", "parts_b", lambda x, y: F.size(F.array_intersect(x, y)))
    counted = (
        pairs.withColumn("cut", cut)
        .join(left, ["a", "cut"])
        .join(right, ["b", "cut", "block"])
        .select("a", "b", "size_a", "size_b", F.aggregate(overlaps, F.lit(0), lambda t, n: t + n).alias("common"))
        .groupBy("a", "b", "size_a", "size_b")
        .agg(F.sum("common").alias("common"))
    )
    union = F.col("size_a") + F.col("size_b") - F.col("common")
    links = materialize(counted.where(100 * F.col("common") >= percent * union).select("a", "b"), "links")
    discard(parts)
    return links


def _long_enough(percent: int) -> Column:
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    return 100 * small >= percent * large


COLUMNS = ("node", "size", "place", "rank", *(f"bits{i}" for i in range(SIGNATURE)))


def _leader_pairs(rows: DataFrame, percent: int, turn: int) -> DataFrame:
    """Each list's members with DRAWS of them, drawn anew for every list and turn.

    A node meets the leaders of some of its lists, those outside its own component
    so far, and keeps the KEPT nearest by parity bits: the pairs grow with the nodes, and a
    group of near copies becomes one component by the members' different leaders.
    """
    some = rows.where((F.col("rank") < FIRST) | (F.col("left") < LAST)).select("gram", *COLUMNS, "group")
    drawn = [
        F.min(F.struct(F.xxhash64("gram", "node", F.lit(turn * DRAWS + i)), *COLUMNS, "group")) for i in range(DRAWS)
    ]
    leaders = some.groupBy("gram").agg(F.array(*drawn).alias("leaders"), F.count(F.lit(1)).alias("n"))
    leaders = leaders.where("n > 1").select("gram", F.explode("leaders").alias("leader"))
    leaders = leaders.select("gram", *(F.col(f"leader.{c}").alias(f"{c}_a") for c in (*COLUMNS, "group")))
    members = some.select("gram", *(F.col(c).alias(f"{c}_b") for c in (*COLUMNS, "group")))
    met = members.join(leaders, "gram").where("node_a != node_b and group_a != group_b")
    kept = met.where(_possible(percent))
    found = kept.select(F.col("node_b").alias("member"), F.struct(_flips().alias("flips"), *_pair()).alias("pair"))
    nearest = F.slice(F.array_sort(F.collect_set("pair")), 1, KEPT)
    pairs = found.groupBy("member").agg(nearest.alias("pairs")).select(F.explode("pairs").alias("pair"))
    return pairs.select("pair.a", "pair.b", "pair.size_a", "pair.size_b").distinct()


def _possible(percent: int) -> Column:
    """Sizes, places and parity bits allow the pair.

    What lies before the first shared n-gram of a set is in no other set, so the
    pair can share what it shares before this n-gram and what is left from it on.
    """
    ahead = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    most = F.least("rank_a", "rank_b") + ahead
    enough = (100 + percent) * most >= percent * (F.col("size_a") + F.col("size_b"))
    return _long_enough(percent) & enough & _near_enough(percent)


def _pair() -> list[Column]:
    """a, b, size_a and size_b with the smaller node first."""
    first = F.col("node_a") < F.col("node_b")
    return [
        F.least("node_a", "node_b").alias("a"),
        F.greatest("node_a", "node_b").alias("b"),
        F.when(first, F.col("size_a")).otherwise(F.col("size_b")).alias("size_a"),
        F.when(first, F.col("size_b")).otherwise(F.col("size_a")).alias("size_b"),
    ]


def _open_lists(nodes: DataFrame, groups: DataFrame | None) -> DataFrame:
    """The written posting rows of lists that touch several components so far."""
    if groups is None:
        grouped = nodes.withColumn("group", F.col("node"))
    else:
        grouped = nodes.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))
    grouped = materialize(grouped, "grouped")
    several = (
        grouped.select(F.explode("grams").alias("gram"), "group")
        .groupBy("gram")
        .agg(F.min("group").alias("low"), F.max("group").alias("high"))
        .where("low < high")
        .select("gram")
    )
    rows = materialize(_postings(grouped, "group").join(several, "gram", "left_semi"), "postings")
    discard(grouped)
    return rows


def _other_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of a list that lie in different components so far."""
    one, two = (
        rows.select("gram", *(F.col(c).alias(f"{c}_{s}") for c in (*COLUMNS, "group"))) for s in "ab"
    )
    met = one.join(two, "gram").where("node_a < node_b and group_a != group_b")
    return met.where(_possible(percent)).select(*_pair()).distinct()


# ---- components -----------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, group): the smallest node that each node of the edges (a, b) reaches.

    Large-star and small-star in turn, each written to the shared folder; both keep
    the components and end in one star per component, after rounds that grow with
    the logarithm of the longest path.
    """
    edges = materialize(edges.select("a", "b").where("a != b").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
        down = materialize(down.distinct(), "edges")
        discard(edges)
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where("a != b").unionByName(least.select("a", F.col("m").alias("b")))
        edges = materialize(small.distinct(), "edges")
        discard(down)
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("group"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("group")).distinct())


def join(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, frequent_from: int = FREQUENT
) -> DataFrame:
    """(doc_id, node, size, group, component_id) of every document; an empty set has no group."""
    source = keyed(narrow(docs, doc_id="bigint", text="string"))
    facts = source.select("doc_id", "ord", "class", F.octet_length("text").alias("bytes"))
    facts = materialize(facts, "facts")
    _, first = first_of_class(facts)
    total = facts.agg(F.sum("bytes")).first()[0] or 0
    levels = occurrence_bitmaps(
        source, partial(ngrams, words=words), first, total, total // BYTES_PER_SHARED, (2, frequent_from)
    )
    prefixes = materialize(_prefixes(source, first, levels, words, percent), "prefixes")
    levels.destroy()
    nodes = materialize(prefixes.drop("class").dropDuplicates(["node"]), "nodes")

    groups, links = None, None
    for turn in range(TURNS + 1):
        rows = _open_lists(nodes, groups)
        found = _leader_pairs(rows, percent, turn) if turn < TURNS else _other_pairs(rows, percent)
        pairs = materialize(found, "pairs")
        discard(rows)
        more = verified(source, first, pairs, words, percent)
        if turn == 0:
            links, groups = more, components(more)
        elif not more.isEmpty():
            links = links.unionByName(more)
            groups = components(links)
    discard(nodes)

    of_class = prefixes.select("class", "node", "size").dropDuplicates(["class"])
    nodes = facts.join(of_class, "class").select("doc_id", "node", "size")
    classes = nodes.groupBy("node").agg(F.min("doc_id").alias("least"))
    classes = classes.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))
    classes = materialize(classes, "classes")
    ids = classes.groupBy("group").agg(F.min("least").alias("component_id"))
    named = classes.join(ids, "group").select("node", "group", "component_id")
    columns = ("doc_id", "node", "size", "group", "component_id")
    some = nodes.where("size > 0").join(named, "node").select(*columns)
    none = nodes.where("size = 0").withColumns(
        {"group": F.lit(None).cast("binary"), "component_id": F.col("doc_id")}
    )
    return some.unionByName(none.select(*columns))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that of the smallest doc_id, as it came.

    Documents without a word are components of their own.  Rows that agree in doc_id
    and set count as one.
    """
    found = join(docs, words, percent)
    first = found.where("group is not null").groupBy("group").agg(
        F.min_by(F.struct("doc_id", "node"), F.struct(F.isnull("doc_id"), "doc_id", "node")).alias("kept")
    )
    alone = found.where("group is null").select("doc_id", "node").distinct()
    kept = first.select("kept.doc_id", "kept.node").unionByName(alone)
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("node").alias("kept_node"))

    node = unused(docs, "node")
    text_at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            nodes = [node_of(ngrams(t, words)) for t in batch.column(text_at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nodes, pa.binary())], [*batch.schema.names, node]
            )

    schema = StructType([*docs.schema, StructField(node, BinaryType())])
    marked = bounded_batches(docs).mapInArrow(run, schema)
    same = marked["doc_id"].cast("bigint").eqNullSafe(kept["kept_id"]) & (
        marked[node] == kept["kept_node"]
    )
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", node]).drop(node)
