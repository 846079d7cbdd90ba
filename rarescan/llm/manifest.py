"""Merkle manifest of a dataset: one tree per source, one tree over the sources.

A row's leaf is the digest of its fields.  Rows of a tree are numbered in order by a
range partitioning, so no tree, however large, meets in one task.  A level is built
by a slot pivot: conditional aggregates spread the children of each parent into
FANOUT columns; the columns one after the other hash to the parent, and all but a
child's own column are its siblings.  Levels are written, so a proof goes down
again over them: each child puts its siblings before its parent's path.

Defined cases: a null field counts as ``-``; an empty text as ``0:``; rows with equal or
null keys stand in the order of their leaves, null keys first; a null source is a
tree of its own and the first; an only row is the root of its tree; an empty table has no
rows and no root; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rarescan.sources.shared import materialize

FANOUT = 3
ROW_BITS = 33  # of a number from monotonically_increasing_id: the place in its partition
LEVELS_PER_WRITE = 4  # paths are written again after so many joins
NO_STEPS = "from_json('[]', 'array<struct<left:string,right:string>>')"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts one after the other; a null part is nothing."""
    return F.sha2(F.concat(*(F.coalesce(p, F.lit("")) for p in parts)).cast("binary"), 256)


def field(value: Column) -> Column:
    """UTF-8 byte count, ``:`` and the value, or ``-`` if there is none."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return digest(*map(field, fields))


def number(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` (tree, ...) with ``node``, its place from 0 in its tree, and ``n``, the tree's size.

    Sorted ranges are written with their places; only a range's share of each tree is
    summed up, one row per (range, tree).
    """
    ranged = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = materialize(ranged.withColumn("place", F.monotonically_increasing_id()), "leaves")
    placed = placed.withColumn("range", F.shiftright("place", ROW_BITS))
    shares = placed.groupBy("range", "tree").agg(
        F.min("place").alias("first"), F.count("*").alias("share")
    )
    whole = Window.partitionBy("tree")
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(
        F.col("range").alias("_range"),
        F.col("tree").alias("_tree"),
        (F.coalesce(F.sum("share").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("share").over(whole).alias("n"),
    )
    same = (F.col("range") == F.col("_range")) & F.col("tree").eqNullSafe(F.col("_tree"))
    joined = placed.join(shares, same)
    return joined.select(*nodes.columns, (F.col("place") + F.col("shift")).alias("node"), "n")


def _slots(name: str) -> list[str]:
    return [f"{name}{slot}" for slot in range(FANOUT)]


def pivot(level: DataFrame) -> DataFrame:
    """One row per parent: its children's columns by slot, and the size of the level below."""
    spread = [
        F.max(F.when(F.col("node") % FANOUT == slot, F.col(name))).alias(f"{name}{slot}")
        for name in level.columns
        if name not in ("tree", "node", "n")
        for slot in range(FANOUT)
    ]
    parent = F.floor(F.col("node") / FANOUT).alias("node")
    return level.groupBy("tree", parent).agg(F.max("n").alias("n"), *spread)


def above(pivoted: DataFrame) -> DataFrame:
    """The next level; a tree of one node is done and keeps it."""
    hashed = F.when(F.col("n") == 1, F.col("hash0")).otherwise(digest(*map(F.col, _slots("hash"))))
    size = F.ceil(F.col("n") / FANOUT)
    return pivoted.select("tree", "node", size.alias("n"), hashed.alias("hash"))


def descend(pivoted: DataFrame, paths: DataFrame) -> DataFrame:
    """``paths`` (tree, node, path, ...) of the parents to those of the children, with their columns."""
    names = [c[:-1] for c in pivoted.columns if c.endswith("0")]
    carried = [c for c in paths.columns if c not in ("tree", "node", "path")]
    own = paths.withColumnsRenamed({"tree": "_tree", "node": "_node"})
    same = (F.col("node") == F.col("_node")) & F.col("tree").eqNullSafe(F.col("_tree"))
    hashes = [F.col(c) for c in _slots("hash")]

    def child(slot: int) -> Column:
        part = lambda cs: F.concat(F.lit(""), *(F.coalesce(c, F.lit("")) for c in cs))
        step = F.struct(part(hashes[:slot]).alias("left"), part(hashes[slot + 1 :]).alias("right"))
        path = F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(F.array(step), "path"))
        values = (F.col(f"{name}{slot}").alias(name) for name in names)
        return F.struct((F.col("node") * FANOUT + slot).alias("node"), path.alias("path"), *values)

    children = F.filter(F.array(*map(child, range(FANOUT))), lambda c: c["hash"].isNotNull())
    joined = pivoted.join(own, same).select("tree", *carried, F.explode(children).alias("child"))
    return joined.select("tree", *carried, "child.*")


@dataclass
class Tree:
    """The written levels of a forest, bottom first, and its top nodes (tree, hash)."""

    levels: list[DataFrame]
    tops: DataFrame

    def paths(self, tops: DataFrame) -> DataFrame:
        """Leaves (tree, node, path, ..., hash, ...) from the paths of the top nodes (tree, path, ...)."""
        paths = tops.withColumn("node", F.lit(0).cast("long"))
        for count, level in enumerate(reversed(self.levels), 1):
            paths = descend(level, paths)
            if count < len(self.levels):
                paths = paths.drop("hash")
                if count % LEVELS_PER_WRITE == 0:
                    paths = materialize(paths, "paths")
        return paths


def build(leaves: DataFrame, order: Sequence[str]) -> Tree:
    """Trees over ``leaves`` (tree, hash, ...), whose nodes stand by ``order``."""
    level = number(leaves, order)
    most = leaves.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    levels = []
    while most > 1 or not levels:
        pivoted = materialize(pivot(level), "level")
        levels.append(pivoted)
        level, most = above(pivoted), -(-most // FANOUT)
    return Tree(levels, level.select("tree", "hash"))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda done, s: digest(s["left"], done, s["right"]))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(leaves: DataFrame) -> DataFrame:
    """(tree, key, leaf, other, subroot, root, path) of ``leaves`` (tree, key, leaf, other).

    ``other`` is carried along: a second digest to test against the same path.
    """
    rows = leaves.select("tree", "key", "other", F.col("leaf").alias("hash"))
    rows = materialize(rows, "digests")
    forest = build(rows, ("key", "hash"))
    subroots = materialize(forest.tops, "subroots")
    # sources are the leaves of the upper tree, whose own tree column has one value
    upper = build(
        subroots.select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("key"), "hash"),
        ("key",),
    )
    tops = upper.tops.select("tree", F.col("hash").alias("root"), F.expr(NO_STEPS).alias("path"))
    lower = upper.paths(tops).select(
        F.col("key").alias("tree"), F.col("hash").alias("subroot"), "root", "path"
    )
    found = forest.paths(materialize(lower, "roots")).withColumnRenamed("hash", "leaf")
    return found.select("tree", "key", "leaf", "other", "subroot", "root", "path")
