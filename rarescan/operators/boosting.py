"""Gradient boosting for two classes by second-order histograms, many models in one pass.

Features are cut into bins once; rows are written as blocks of bins, labels, weights and
margins.  A pass sums gradients, hessians and rows per (model, node, bin) inside each
task, adds the sums of all tasks, in a tree when they are many, and hands the driver one
histogram per open node: its size depends on bins and leaves, not on rows.  Models, be it
folds, candidates of a search or both, are an axis of those sums, so a pass over the
rows serves all of them.

Trees grow best leaf first up to ``num_leaves``; a pass opens all leaves that may still be
split, so a tree takes about as many passes as it has levels, and a larger child has its
parent's histogram less its sibling's.  Without ``num_leaves`` the same procedure splits
whatever gains, level by level.  A leaf is worth -T(G) / (H + reg_lambda), T shrinking by reg_alpha.
Afterwards splits that gain less than ``min_gain`` are taken back from the bottom.

A row holds codes, each standing for the bins of several features: a code's sums give those of its features, so
a pass counts each row a few times instead of once per feature.  Sums leave out features a tree may not split by, and
rows where their weights bound a leaf already.

The first pass of a tree moves the margins by the trees before it and keeps them with the blocks, unless many
models make margins the larger part of a row.  They are written every few trees, so a lost executor repeats little.

Where the blocks of all rows are small (``LOCAL_BYTES``), they go to all executors and a task fits a whole model
by the same steps: no jobs per pass, and models side by side.
Defined cases: rows without label or weight count as 0 and 1; a null or NaN feature lies in the
lowest bin; one class only gives that class's (smoothed) rate; equal gains take the first
feature and cut.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarescan.operators.perceptron import sliced
from rarescan.sources.shared import discard, materialize

MAX_BINS = 64
TREES_PER_WRITE = 10
HISTOGRAM_BYTES = 256_000_000  # of all models fitted at once, on the driver
COLLECTED_BYTES = 32_000_000  # of all tasks' sums; more of them are added in a tree
ROWS_PER_TASK = 32_768  # at least; a task's sums are as large whatever its rows
LOCAL_BYTES = 32_000_000  # of blocks a single task fits a model on
PACKED = 4_400  # most values of a code: two features of 65 bins
PACKED_LOCAL = 256  # few rows would not pay for the sums of large codes
ROWS_AT_ONCE = 1 << 18  # summed together where codes are large
SUMMARY, SUMMARY_ROWS = 4_096, 32_768  # points of a feature's distribution, kept and gathered
LEAST_GAIN = 1e-6
NO_LIMIT = 1 << 20

BLOCKS = "n int, codes binary, label binary, weight binary, fold binary, hash binary, margins binary"
NODES = "tree int, node int, feature int, cut double, left int, right int, value double, gain double, cover double"


@dataclass(frozen=True)
class Boost:
    """How one model is fitted; ``without_fold`` leaves the rows of a fold out, ``class_weights``
    multiply the weights of its rows."""

    rounds: int = 100
    learning_rate: float = 0.1
    max_depth: int = 6  # below 1: no limit
    num_leaves: int | None = None
    min_child_weight: float = 1.0
    min_child_rows: int = 1
    min_gain: float = 0.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    subsample: float = 1.0
    colsample: float = 1.0
    seed: int = 42
    without_fold: int | None = None
    class_weights: tuple[float, float] = (1.0, 1.0)

    def counts_rows(self) -> bool:
        """Whether rows bound a leaf that weights do not bound."""
        return self.min_child_rows > 1 or self.min_child_weight < 0.01

    def depth(self) -> int:
        return self.max_depth if self.max_depth > 0 else NO_LIMIT

    def leaves(self) -> int:
        most = self.num_leaves or NO_LIMIT
        return min(most, 1 << self.max_depth) if 0 < self.max_depth < 20 else most

    def shrunk(self, g):
        return np.sign(g) * np.maximum(np.abs(g) - self.reg_alpha, 0.0)

    def gain(self, g, h):
        return self.shrunk(g) ** 2 / np.maximum(h + self.reg_lambda, 1e-16)

    def value(self, g: float, h: float) -> float:
        return float(-self.shrunk(g) / max(h + self.reg_lambda, 1e-16)) * self.learning_rate

    def columns(self, features: int, tree: int) -> np.ndarray:
        """The features a tree may split by."""
        if self.colsample >= 1:
            return np.arange(features)
        count = max(1, round(self.colsample * features))
        return np.sort(np.random.default_rng([self.seed, tree]).permutation(features)[:count])

    def sampled(self, hashes: np.ndarray, tree: int) -> np.ndarray:
        """Which rows a tree learns from; a row's key and the tree decide."""
        if self.subsample >= 1:
            return np.ones(len(hashes), bool)
        x = hashes ^ np.uint64((self.seed * 0x9E3779B97F4A7C15 + tree * 0xD1342543DE82EF95) % (1 << 64))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (x ^ (x >> np.uint64(32))) < np.uint64(int(self.subsample * ((1 << 64) - 1)))


# ---- bins ---------------------------------------------------------------------------


def _merged(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their weights, increasing."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    return values[first], np.add.reduceat(weights, first) if len(first) else weights


def _shortened(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most ``SUMMARY`` of many values, each with the weight of those up to it; the least value stays."""
    if len(values) <= SUMMARY:
        return values, weights
    done = np.cumsum(weights)
    at = np.unique(np.searchsorted(done, np.linspace(done[0], done[-1], SUMMARY)).clip(0, len(done) - 1))
    return values[at], np.diff(done[at], prepend=0.0)


def _summaries(batches: Iterator[pa.RecordBatch], slots: int) -> Iterator[pa.RecordBatch]:
    """A task's distribution per feature; NaN is left out."""
    kept = [(np.zeros(0), np.zeros(0))] * slots
    waiting: list[list] = [[] for _ in range(slots)]
    sizes = [0] * slots

    def close(slot: int) -> None:
        parts = [kept[slot], *waiting[slot]]
        kept[slot] = _shortened(*_merged(*(np.concatenate(p) for p in zip(*parts))))
        waiting[slot], sizes[slot] = [], 0

    for batch in batches:
        x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, slots)
        for slot in range(slots):
            column = x[:, slot]
            values, counts = np.unique(column[~np.isnan(column)], return_counts=True)
            waiting[slot].append((values, counts.astype(np.float64)))
            sizes[slot] += len(values)
            if sizes[slot] >= SUMMARY_ROWS:
                close(slot)
    for slot in range(slots):
        close(slot)
    columns = [[v.tobytes() for v, _ in kept], [w.tobytes() for _, w in kept]]
    arrays = [pa.array(range(slots), pa.int32()), *(pa.array(c, pa.binary()) for c in columns)]
    yield pa.record_batch(arrays, ["slot", "v", "w"])


def _cuts_of(parts: pd.DataFrame, max_bins: int) -> pd.DataFrame:
    read = lambda name: np.concatenate([np.frombuffer(b, np.float64) for b in parts[name]])
    values, weights = _merged(read("v"), read("w"))
    found: list[float] = []
    if len(values):
        done = np.cumsum(weights)
        at = np.searchsorted(done, np.arange(max_bins) / max_bins * done[-1] * (1 - 1e-15))
        found = np.unique(values[at]).tolist()
    return pd.DataFrame({"slot": [int(parts["slot"].iloc[0])], "cuts": [found]})


def feature_cuts(df: DataFrame, features: str, max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Per feature increasing cuts at approximate quantiles of all rows, the least value among them."""
    rows = df.select(vector_to_array(features).alias("x"))
    first = rows.first()
    slots = len(first["x"]) if first else 0
    return array_cuts(rows, slots, max_bins) if slots else []


def array_cuts(rows: DataFrame, slots: int, max_bins: int) -> list[np.ndarray]:
    """The same per slot of the array column ``x``."""
    rows = rows.select("x")
    parts = rows.mapInArrow(lambda b: _summaries(b, slots), "slot int, v binary, w binary")
    found = parts.groupBy("slot").applyInPandas(lambda p: _cuts_of(p, max_bins), "slot int, cuts array<double>")
    cuts = {r["slot"]: r["cuts"] for r in found.collect()}
    return [np.array(cuts.get(slot) or [0.0]) for slot in range(slots)]


class Packing:
    """Features that share a code: a code is the sum of their bins, each times its stride."""

    def __init__(self, sizes: Sequence[int], most: int):
        self.groups: list[list[int]] = []
        self.values: list[int] = []  # of each code
        self.place: dict[int, tuple[int, int, int]] = {}  # code, stride and size of a feature
        for feature in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
            size = int(sizes[feature])
            at = next((i for i, v in enumerate(self.values) if v * size <= most), len(self.groups))
            if at == len(self.groups):
                self.groups.append([])
                self.values.append(1)
            self.place[feature] = at, self.values[at], size
            self.groups[at].append(feature)
            self.values[at] *= size
        self.kind = np.uint8 if max(self.values, default=1) <= 256 else np.uint16
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(int)

    def row_bytes(self) -> int:
        return len(self.groups) * np.dtype(self.kind).itemsize + 21

    def packed(self, bins: np.ndarray) -> np.ndarray:
        """Codes (code, row) of bins (feature, row)."""
        codes = np.zeros((len(self.groups), bins.shape[1]), self.kind)
        for feature, (at, stride, _) in self.place.items():
            codes[at] += bins[feature].astype(self.kind) * self.kind(stride)
        return codes

    def goes_left(self, feature: int, cut: int) -> tuple[int, np.ndarray]:
        """The code that holds a feature and, per value of it, whether the bin is at most ``cut``."""
        at, stride, size = self.place[feature]
        return at, np.arange(self.values[at]) // stride % size <= cut

    def add(self, sums: np.ndarray, codes: np.ndarray, place: np.ndarray | None, channels: Sequence, columns) -> None:
        """Add to ``sums`` (channel, part, bin) what rows of those codes and parts hold; None counts."""
        wanted, parts = set(map(int, columns)), sums.shape[1]
        for at, (group, values) in enumerate(zip(self.groups, self.values)):
            if wanted.isdisjoint(group):
                continue
            slot = codes[at].astype(np.intp)
            if parts > 1:
                slot += place * values
            found = np.stack([np.bincount(slot, c, parts * values) for c in channels])
            for feature in group:
                _, stride, size = self.place[feature]
                first = self.offsets[feature]
                split = found.reshape(len(channels), parts, -1, size, stride)
                sums[:, :, first : first + size] += split[:, :, 0, :, 0] if len(group) == 1 else split.sum(axis=(2, 4))


def _short(values: np.ndarray) -> bytes:
    """A column of equal values is written as one."""
    same = len(values) > 0 and (values == values[0]).all()
    return (values[:1] if same else values).tobytes()


def _blocks(
    batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray], packing: Packing, starts: Sequence
) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, packing.row_bytes() + 8 * len(starts)):
        x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
        bins = np.empty(x.shape[::-1], np.uint8)  # feature by feature
        for slot, cut in enumerate(cuts):
            bins[slot] = np.searchsorted(cut, np.nan_to_num(x[:, slot], nan=-np.inf))
        whole = lambda name, kind: batch[name].to_numpy(zero_copy_only=False).astype(kind)
        margins = np.tile(np.array(starts, np.float64)[:, None], batch.num_rows)
        columns = [
            packing.packed(bins).tobytes(), whole("label", np.uint8).tobytes(), _short(whole("weight", np.float64)),
            _short(whole("fold", np.int32)), whole("hash", np.int64).tobytes(), margins.tobytes(),
        ]
        arrays = [pa.array([batch.num_rows], pa.int32())]
        arrays += [pa.array([c], pa.binary()) for c in columns]
        yield pa.record_batch(arrays, ["n", "codes", "label", "weight", "fold", "hash", "margins"])


class Block:
    def __init__(self, row: dict, packing: Packing, models: int):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        whole = lambda name, kind: np.broadcast_to(read(name, kind), n)
        self.row, n, self.packing = row, row["n"], packing
        self.codes = read("codes", packing.kind).reshape(len(packing.groups), n)
        self.label, self.weight = read("label", np.uint8), whole("weight", np.float64)
        self.fold, self.hash = whole("fold", np.int32), read("hash", np.uint64)
        self.margins = read("margins", np.float64).reshape(models, n)

    def left(self, feature: int, cut: int, rows: np.ndarray | None) -> np.ndarray:
        at, table = self.packing.goes_left(feature, cut)
        return table[self.codes[at] if rows is None else self.codes[at][rows]]

    def moved(self, recent: list[list[Tree]]) -> bytes:
        """The margins after the latest trees."""
        margins = [m + sum(t.value[t.leaves(self.left, len(m))] for t in trees) for m, trees in zip(self.margins, recent)]
        return np.stack(margins).tobytes()

    def of_tree(self, how: Boost, tree: int) -> np.ndarray:
        """The rows a tree learns from."""
        used = how.sampled(self.hash, tree) & (self.weight > 0)
        if how.without_fold is not None:
            used &= self.fold != how.without_fold
        return np.flatnonzero(used)

    def slopes(self, how: Boost, margin: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients and hessians of rows at their margins."""
        p = 1 / (1 + np.exp(-margin))
        label = self.label[rows]
        weight = self.weight[rows] * np.array(how.class_weights)[label]
        return weight * (p - label), weight * p * (1 - p)


# ---- trees --------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes as arrays; ``feature`` -1 is a leaf, ``cut`` the last bin that goes left."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        def left(feature, cut, rows):
            return (bins[:, feature] if rows is None else bins[rows, feature]) <= cut

        return self.leaves(left, len(bins))

    def leaves(self, goes_left, count: int, some: np.ndarray | None = None) -> np.ndarray:
        """The leaf of each of ``count`` rows, or of ``some``; ``goes_left`` compares a feature with a cut (None: all rows)."""
        at = np.zeros(count if some is None else len(some), np.int32)
        todo = [(0, some, None)]  # node, rows, their places in the answer
        while todo:
            node, rows, places = todo.pop()
            if self.feature[node] < 0:
                at[slice(None) if places is None else places] = node
                continue
            left = goes_left(self.feature[node], self.cut[node], rows)
            for child, side in ((self.left[node], left), (self.right[node], ~left)):
                own = np.flatnonzero(side) if places is None else places[side]
                todo.append((child, own if rows is None else rows[side], own))
        return at

    def of(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.leaf_of(bins)]


@dataclass
class Node:
    g: float
    h: float
    rows: float
    depth: int
    sums: np.ndarray | None = None
    split: tuple | None = None  # gain, feature, bin, and g, h, rows of the left child
    open: bool = True  # may still be split, but its histogram is not known
    children: tuple[int, int] | None = None
    taken: bool = False
    parent: int | None = None


@dataclass
class Growing:
    """One tree of one model while it grows."""

    how: Boost
    columns: np.ndarray
    offsets: np.ndarray  # where each feature's bins begin, and the number of all
    nodes: list[Node] = field(default_factory=lambda: [Node(0.0, 0.0, 0.0, 0)])

    def learn(self, number: int, sums: np.ndarray) -> None:
        node = self.nodes[number]
        node.sums, node.open = sums, False
        if not number:
            one = self.columns[0]
            first = sums[:, self.offsets[one] : self.offsets[one + 1]].sum(axis=1)
            node.g, node.h, node.rows = map(float, first)
        if node.depth < self.how.depth():
            node.split = self._best(node)

    def _best(self, node: Node) -> tuple | None:
        sums, how, offsets = node.sums, self.how, self.offsets
        done = sums.cumsum(axis=1)
        before = np.concatenate([np.zeros((3, 1)), done], axis=1)[:, offsets[:-1]]
        width = np.diff(offsets)
        left = done - np.repeat(before, width, axis=1)
        whole = np.array([[node.g], [node.h], [node.rows]])
        right = whole - left
        allowed = np.zeros(len(width), bool)
        allowed[self.columns] = True
        ok = np.repeat(allowed, width)
        for side in (left, right):
            ok &= (side[2] >= max(how.min_child_rows, 1)) & (side[1] >= how.min_child_weight)
        gain = how.gain(left[0], left[1]) + how.gain(right[0], right[1]) - how.gain(node.g, node.h)
        gain = np.where(ok, gain, -np.inf)
        best = int(gain.argmax())
        if not gain[best] > LEAST_GAIN:
            return None
        feature = int(np.searchsorted(offsets, best, side="right") - 1)
        return (float(gain[best]), feature, best - int(offsets[feature]), *map(float, left[:, best]))

    def _divide(self, number: int) -> tuple[int, int]:
        node = self.nodes[number]
        if node.children is None:
            _, _, _, g, h, rows = node.split
            node.children = len(self.nodes), len(self.nodes) + 1
            for part in ((g, h, rows), (node.g - g, node.h - h, node.rows - rows)):
                child = Node(*part, node.depth + 1, parent=number)
                least = 2 * max(self.how.min_child_rows, 1)
                child.open = child.depth < self.how.depth() and child.rows >= least
                child.open &= child.h >= 2 * self.how.min_child_weight
                self.nodes.append(child)
        return node.children

    def wanted(self) -> list[int]:
        """Split as far as known; nodes whose histograms are needed to go on (none: done)."""
        if self.nodes[0].open:
            return [0]
        if self.how.num_leaves is None:  # whatever gains is split
            asked = []
            for number in range(len(self.nodes)):
                node = self.nodes[number]
                if node.split and not node.taken:
                    node.taken = True
                    pair = self._divide(number)
                    if any(self.nodes[c].open for c in pair):
                        asked.append(self._smaller(node))
            return asked
        leaves = {0}
        for number, node in enumerate(self.nodes):
            if node.taken:
                leaves.discard(number)
                leaves.update(node.children)
        while len(leaves) < self.how.leaves():
            gains = sorted((-self.nodes[i].split[0], i) for i in leaves if self.nodes[i].split)
            if not gains or any(self.nodes[i].open for i in leaves):
                break
            best = gains[0][1]
            self.nodes[best].taken = True
            leaves.remove(best)
            leaves.update(self._divide(best))
        room = self.how.leaves() - len(leaves)
        if room <= 0 or not any(self.nodes[i].open for i in leaves):
            return []
        # what stands open, and beforehand what may be split next
        parents = [n for n in self.nodes if n.taken and any(self.nodes[c].open for c in n.children)]
        for _, number in gains[:room]:
            self._divide(number)
            parents.append(self.nodes[number])
        asked = []
        for parent in parents:
            if any(self.nodes[c].open for c in parent.children):
                asked.append(self._smaller(parent))
        return asked

    def _smaller(self, parent: Node) -> int:
        one, other = parent.children
        return other if self.nodes[other].rows < self.nodes[one].rows else one

    def answer(self, number: int, sums: np.ndarray) -> None:
        """A node's histogram; its sibling has the rest of the parent's."""
        if len(sums) < 3:  # rows were not counted: a weight of min_child_weight stands for one
            sums = np.vstack([sums, sums[1] / self.how.min_child_weight])
        if not number:
            return self.learn(0, sums)
        parent = self.nodes[self.nodes[number].parent]
        other = sum(parent.children) - number
        for child, own in ((number, sums), (other, parent.sums - sums)):
            if self.nodes[child].open:
                self.learn(child, own)
        parent.sums = None

    def tree(self, final: bool) -> Tree:
        """All nodes while growing; the finished tree has only the splits taken, then pruned."""
        used = {i for i, n in enumerate(self.nodes) if (n.taken if final else n.children)}
        if final:
            for number in sorted(used, reverse=True):  # children stand after their parents
                node = self.nodes[number]
                if node.split[0] < self.how.min_gain and not used.intersection(node.children):
                    used.remove(number)
        kept = list(range(len(self.nodes)))
        if final:
            kept, todo = [], [0]
            while todo:  # left before right
                kept.append(todo.pop())
                if kept[-1] in used:
                    todo += reversed(self.nodes[kept[-1]].children)
        place = {number: at for at, number in enumerate(kept)}
        nodes = [(self.nodes[i], i in used) for i in kept]
        inner = lambda pick, rest: np.array([pick(n) if split else rest for n, split in nodes])
        return Tree(
            inner(lambda n: n.split[1], -1),
            inner(lambda n: n.split[2], 0),
            inner(lambda n: place[n.children[0]], -1),
            inner(lambda n: place[n.children[1]], -1),
            np.array([self.how.value(n.g, n.h) for n, _ in nodes]),
            inner(lambda n: n.split[0], 0.0),
            np.array([n.h for n, _ in nodes]),
        )


# ---- passes ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Pass:
    """What the tasks of a pass sum: per model the nodes asked for, each with a slot."""

    hows: dict[int, Boost]
    models: int
    packing: Packing
    recent: dict[int, list[Tree]]  # not yet in the written margins
    trees: dict[int, Tree]  # as far as grown
    slots: dict[int, dict[int, int]]
    columns: dict[int, np.ndarray]
    number: int

    def __call__(self, rows: Iterator) -> Iterator[dict[int, np.ndarray]]:
        """Gradients, hessians and, if they count, rows per slot and bin over a task's blocks."""
        total = int(self.packing.offsets[-1])
        sums = {m: np.zeros((2 + self.hows[m].counts_rows(), len(nodes), total)) for m, nodes in self.slots.items()}
        waiting: dict[int, list] = {m: [] for m in self.slots}
        # large codes are worth the sums of many rows only
        most = ROWS_AT_ONCE // len(self.slots) if self.packing.kind == np.uint16 else 1

        def add(model: int) -> None:
            if waiting[model]:
                codes, place, g, h = (np.concatenate(c, axis=-1) for c in zip(*waiting[model]))
                channels = (g, h, None)[: len(sums[model])]
                self.packing.add(sums[model], codes, place, channels, self.columns[model])
                waiting[model] = []

        for row in rows:
            block = Block(row, self.packing, self.models)
            for model, nodes in self.slots.items():
                how, tree = self.hows[model], self.trees[model]
                places = np.full(len(tree.feature), -1)
                places[list(nodes)] = np.arange(len(nodes))
                own = block.of_tree(how, self.number)
                place = places[tree.leaves(block.left, len(block.label), own)]
                if (place < 0).any():
                    own, place = own[place >= 0], place[place >= 0]
                if not len(own):
                    continue
                margin = block.margins[model][own]
                for t in self.recent[model]:
                    margin = margin + t.value[t.leaves(block.left, len(block.label), own)]
                waiting[model].append((block.codes[:, own], place, *block.slopes(how, margin, own)))
                if sum(len(w[1]) for w in waiting[model]) >= most:
                    add(model)
        for model in self.slots:
            add(model)
        yield {slot: sums[model][:, at] for model, nodes in self.slots.items() for at, slot in enumerate(nodes.values())}


@dataclass(frozen=True)
class Move:
    """A task's blocks with the margins after further trees."""

    packing: Packing
    recent: list[list[Tree]]

    def __call__(self, rows: Iterator) -> Iterator[dict]:
        for row in rows:
            block = Block(row, self.packing, len(self.recent))
            names = ("n", "codes", "label", "weight", "fold", "hash")
            yield {name: row[name] for name in names} | {"margins": block.moved(self.recent)}


def _added(one: dict[int, np.ndarray], other: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    for slot, sums in other.items():
        one[slot] = one[slot] + sums if slot in one else sums
    return one


def _moved(batches: Iterator[pa.RecordBatch], packing: Packing, recent: list[list[Tree]]) -> Iterator[pa.RecordBatch]:
    """Blocks with the margins after the latest trees."""
    for batch in batches:
        out = [Block(row, packing, len(recent)).moved(recent) for row in batch.to_pylist()]
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.record_batch([*columns, pa.array(out, pa.binary())], batch.schema.names)


@dataclass
class Boosted:
    """A fitted model: its margin before the first tree, its trees, and the cuts of its bins."""

    how: Boost
    start: float
    trees: list[Tree]
    cuts: list[np.ndarray]
    # ROC-AUC on the fold left out and on all other rows, where the fit has both at hand
    areas: tuple[float, float] | None = None

    def nodes(self) -> pd.DataFrame:
        frames = []
        for number, tree in enumerate(self.trees):
            cut = [float(self.cuts[f][c]) if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.cut)]
            frames.append(
                pd.DataFrame(
                    {
                        "tree": number, "node": np.arange(len(tree.feature)), "feature": tree.feature, "cut": cut,
                        "left": tree.left, "right": tree.right, "value": tree.value, "gain": tree.gain,
                        "cover": tree.cover,
                    }
                )
            )
        names = [part.split()[0] for part in NODES.split(", ")]
        return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame(columns=names)


def _starts(rows: DataFrame, hows: Sequence[Boost]) -> tuple[list[float], int]:
    """Log odds of the weighted rate of class 1 among each model's rows; the number of rows."""
    found = rows.groupBy("fold", "label").agg(F.sum("weight"), F.count("*")).collect()
    sums, starts = [r[:3] for r in found], []
    for how in hows:
        parts = [
            (y, w * how.class_weights[int(y)])
            for fold, y, w in sums
            if how.without_fold is None or fold != how.without_fold
        ]
        ones, whole = sum(w for y, w in parts if y), sum(w for _, w in parts)
        rate = min(max(ones / whole if whole else 0.5, 1e-6), 1 - 1e-6)
        starts.append(math.log(rate / (1 - rate)))
    return starts, sum(r[3] for r in found)


def fit(
    df: DataFrame,
    hows: Sequence[Boost],
    label: str,
    key: str,
    features: str = "features",
    weight: Column | None = None,
    fold: str | None = None,
    max_bins: int = MAX_BINS,
    cuts: Sequence[np.ndarray] | None = None,
) -> list[Boosted]:
    """One model per entry of ``hows``, all grown in the same passes over ``df``.

    ``cuts``: increasing values per feature, at most 255, instead of quantiles.
    """
    rows = df.select(
        vector_to_array(features).alias("x"),
        F.coalesce(F.col(label).cast("double"), F.lit(0.0)).alias("label"),
        F.coalesce(weight if weight is not None else F.lit(1.0), F.lit(1.0)).cast("double").alias("weight"),
        F.coalesce(F.col(fold).cast("int") if fold else F.lit(-1), F.lit(-1)).alias("fold"),
        F.xxhash64(key).alias("hash"),
    )
    cuts = feature_cuts(df, features, max_bins) if cuts is None else list(cuts)
    offsets = np.concatenate([[0], np.cumsum([len(c) + 1 for c in cuts])])
    each = max(min(h.leaves(), 64) for h in hows) * int(offsets[-1]) * 24
    together = max(1, HISTOGRAM_BYTES // each)
    starts, count = _starts(rows, hows)
    small = Packing(np.diff(offsets), PACKED_LOCAL)
    if count * small.row_bytes() <= LOCAL_BYTES:
        return _fit_local(rows, hows, starts, cuts, small)
    # of few models, whose sums of large codes are few
    packing = Packing(np.diff(offsets), PACKED) if min(len(hows), together) <= 8 else small
    out: list[Boosted] = []
    for first in range(0, len(hows), together):
        part = slice(first, first + together)
        out += _fit_together(rows, hows[part], starts[part], count, cuts, packing)
    return out


def _fit_together(
    rows: DataFrame, hows: Sequence[Boost], starts: list[float], count: int, cuts: list[np.ndarray], packing: Packing
) -> list[Boosted]:
    features, models, offsets = len(cuts), len(hows), packing.offsets
    tasks = max(1, min(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-count // ROWS_PER_TASK)))

    def cache(blocks: DataFrame):
        """Very many small jobs: no plan each time.  A lost block is read again."""
        return blocks.coalesce(tasks).rdd.persist(StorageLevel.MEMORY_AND_DISK)

    blocks = materialize(rows.mapInArrow(lambda b: _blocks(b, cuts, packing, starts), BLOCKS), "blocks", blocks=True)
    cached = cache(blocks)
    # margins that are the larger part of a row are not kept again for each tree
    each_tree = 8 * models <= 2 * features
    trees: list[list[Tree]] = [[] for _ in hows]
    recent: list[list[Tree]] = [[] for _ in hows]  # since the blocks were written
    ahead: list[list[Tree]] = [[] for _ in hows]  # not yet in the cached margins
    for number in range(max(h.rounds for h in hows)):
        before = None
        if each_tree and any(ahead):
            before = cached
            cached = before.mapPartitions(Move(packing, ahead)).persist(StorageLevel.MEMORY_AND_DISK)
            ahead = [[] for _ in hows]
        growing = {
            m: Growing(how, how.columns(features, number), offsets)
            for m, how in enumerate(hows)
            if number < how.rounds
        }
        while asked := {m: nodes for m, g in growing.items() if (nodes := g.wanted())}:
            places = [(m, node) for m, nodes in asked.items() for node in nodes]
            slots: dict[int, dict[int, int]] = {}
            for slot, (m, node) in enumerate(places):
                slots.setdefault(m, {})[node] = slot
            step = Pass(
                {m: hows[m] for m in slots}, models, packing, {m: ahead[m] for m in slots},
                {m: growing[m].tree(False) for m in slots}, slots, {m: growing[m].columns for m in slots}, number,
            )
            found = cached.mapPartitions(step)
            if len(places) * int(offsets[-1]) * 24 * tasks <= COLLECTED_BYTES:
                sums_of: dict[int, np.ndarray] = reduce(_added, found.collect(), {})
            else:
                sums_of = found.treeAggregate({}, _added, _added)
            if before is not None:
                before, _ = None, before.unpersist()
            for slot, (m, node) in enumerate(places):
                growing[m].answer(node, sums_of.get(slot, np.zeros((3, int(offsets[-1])))))
        for m, grown in growing.items():
            tree = grown.tree(True)
            trees[m].append(tree)
            recent[m].append(tree)
            ahead[m].append(tree)
        if (number + 1) % TREES_PER_WRITE == 0 and number + 1 < max(h.rounds for h in hows):
            moved = blocks.mapInArrow(lambda b, r=recent: _moved(b, packing, r), BLOCKS)
            written = materialize(moved, "blocks", blocks=True)
            cached.unpersist()
            discard(blocks)
            blocks, cached = written, cache(written)
            recent, ahead = [[] for _ in hows], [[] for _ in hows]
    cached.unpersist()
    discard(blocks)
    return [Boosted(h, s, t, cuts) for h, s, t in zip(hows, starts, trees)]


# ---- few rows: a task fits a whole model ------------------------------------------------


def _area(margin: np.ndarray, label: np.ndarray) -> float:
    """ROC-AUC, ties counted half; 0.5 without both classes."""
    ones = int((label > 0).sum())
    if not 0 < ones < len(label):
        return 0.5
    _, rank, counts = np.unique(margin, return_inverse=True, return_counts=True)
    middle = np.cumsum(counts) - (counts - 1) / 2
    return float((middle[rank][label > 0].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones)))


def _joined(rows: Sequence[dict], packing: Packing) -> Block:
    """All blocks as one."""
    blocks = [Block(row, packing, 0) for row in rows]
    whole = Block({"n": 0, "codes": b"", "label": b"", "weight": b"\0" * 8, "fold": b"\0" * 4, "hash": b"", "margins": b""}, packing, 0)
    for name in ("codes", "label", "weight", "fold", "hash"):
        if blocks:
            setattr(whole, name, np.concatenate([getattr(b, name) for b in blocks], axis=-1))
    return whole


def _grown(table: Block, how: Boost, start: float, packing: Packing) -> tuple[list[Tree], np.ndarray]:
    """The trees of one model and the margins of all rows after them."""
    count, total = len(table.label), int(packing.offsets[-1])
    margin, trees = np.full(count, start), []
    g, h = np.empty(count), np.empty(count)
    for number in range(how.rounds):
        own = table.of_tree(how, number)
        g[own], h[own] = table.slopes(how, margin[own], own)
        growing = Growing(how, how.columns(len(packing.offsets) - 1, number), packing.offsets)
        rows = {0: own}
        while asked := growing.wanted():
            for node in asked:
                parent = growing.nodes[node].parent
                if parent is not None:
                    split, inside = growing.nodes[parent].split, rows.pop(parent)
                    left = table.left(split[1], split[2], inside)
                    rows |= dict(zip(growing.nodes[parent].children, (inside[left], inside[~left])))
            at = np.concatenate([rows[node] for node in asked])
            place = np.repeat(np.arange(len(asked)), [len(rows[node]) for node in asked])
            sums = np.zeros((2 + how.counts_rows(), len(asked), total))
            packing.add(sums, table.codes[:, at], place, (g[at], h[at], None)[: len(sums)], growing.columns)
            for slot, node in enumerate(asked):
                growing.answer(node, sums[:, slot])
        tree = growing.tree(True)
        trees.append(tree)
        margin += tree.value[tree.leaves(table.left, count)]
    return trees, margin


def _fit_local(
    rows: DataFrame, hows: Sequence[Boost], starts: list[float], cuts: list[np.ndarray], packing: Packing
) -> list[Boosted]:
    spark = rows.sparkSession
    blocks = materialize(rows.mapInArrow(lambda b: _blocks(b, cuts, packing, ()), BLOCKS), "blocks", blocks=True)
    sent = spark.sparkContext.broadcast([row.asDict() for row in blocks.collect()])

    def one(number: int) -> tuple[int, list[Tree], tuple[float, float]]:
        table, how = _joined(sent.value, packing), hows[number]
        trees, margin = _grown(table, how, starts[number], packing)
        held = table.fold == how.without_fold if how.without_fold is not None else np.zeros(len(margin), bool)
        return number, trees, (_area(margin[held], table.label[held]), _area(margin[~held], table.label[~held]))

    # the longest first
    order = sorted(range(len(hows)), key=lambda n: -hows[n].rounds * min(hows[n].depth(), 12))
    found = spark.sparkContext.parallelize(order, max(1, len(order))).map(one).collect()
    sent.destroy()
    discard(blocks)
    fitted = {number: (trees, areas) for number, trees, areas in found}
    return [Boosted(h, s, fitted[n][0], cuts, fitted[n][1]) for n, (h, s) in enumerate(zip(hows, starts))]


# ---- as a stage of a pipeline -----------------------------------------------------------


def margin_udf(nodes: pd.DataFrame, start: float):
    """A column function: features as an array -> margin."""
    nodes = nodes.sort_values(["tree", "node"])
    roots = np.flatnonzero(nodes["node"].to_numpy() == 0)
    base = np.repeat(roots, np.diff(np.append(roots, len(nodes))))
    part = {c: nodes[c].to_numpy() for c in ("feature", "cut", "value")}
    left, right = nodes["left"].to_numpy() + base, nodes["right"].to_numpy() + base

    @F.pandas_udf(T.DoubleType())
    def margin(x: pd.Series) -> pd.Series:
        out = np.full(len(x), start)
        if not len(x):
            return pd.Series(out)
        matrix = np.nan_to_num(np.stack(x.to_numpy()), nan=-np.inf)
        for root in roots:
            at = np.full(len(x), root)
            rows = np.arange(len(x)) if part["feature"][root] >= 0 else np.zeros(0, int)
            while len(rows):
                node = at[rows]
                goes_left = matrix[rows, part["feature"][node]] <= part["cut"][node]
                at[rows] = np.where(goes_left, left[node], right[node])
                rows = rows[part["feature"][at[rows]] >= 0]
            out += part["value"][at]
        return pd.Series(out)

    return margin


class _Columns(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "vector of both", TypeConverters.toString)
    rawPredictionCol = Param(Params._dummy(), "rawPredictionCol", "margins", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "class", TypeConverters.toString)


COLUMNS = ("featuresCol", "probabilityCol", "rawPredictionCol", "predictionCol")


class HistogramBooster(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Boosting as above; ``settings`` are the fields of ``Boost`` as JSON."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "key column", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weight column, empty: none", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "fields of Boost as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", probabilityCol: str = "probability",
        rawPredictionCol: str = "rawPrediction", predictionCol: str = "prediction", labelCol: str = "label",
        keyCol: str = "key", weightCol: str = "", settings: str = "{}",
    ):
        super().__init__()
        self._setDefault(
            featuresCol="features", probabilityCol="probability", rawPredictionCol="rawPrediction",
            predictionCol="prediction", labelCol="label", keyCol="key", weightCol="", settings="{}",
        )
        self._set(**self._input_kwargs)

    def how(self) -> Boost:
        return Boost(**json.loads(self.getOrDefault(self.settings)))

    def model_of(self, fitted: Boosted) -> HistogramBoosterModel:
        names = {c: self.getOrDefault(self.getParam(c)) for c in COLUMNS}
        model = HistogramBoosterModel(start=fitted.start, size=len(fitted.cuts), **names)
        model.nodes = fitted.nodes()
        return model

    def _fit(self, dataset: DataFrame) -> HistogramBoosterModel:
        get = lambda name: self.getOrDefault(self.getParam(name))
        weight = F.col(get("weightCol")) if get("weightCol") else None
        (fitted,) = fit(dataset, [self.how()], get("labelCol"), get("keyCol"), get("featuresCol"), weight)
        return self.model_of(fitted)._resetUid(self.uid)


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.sparkSession.createDataFrame(self.instance.nodes, NODES).write.parquet(f"{path}/nodes")


class _Reader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.nodes = self.sparkSession.read.parquet(f"{path}/nodes").toPandas()
        return model


class HistogramBoosterModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    start = Param(Params._dummy(), "start", "margin before the first tree", TypeConverters.toFloat)
    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)

    nodes: pd.DataFrame

    @keyword_only
    def __init__(
        self, *, featuresCol: str | None = None, probabilityCol: str | None = None,
        rawPredictionCol: str | None = None, predictionCol: str | None = None, start: float | None = None,
        size: int | None = None,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def featureImportances(self):
        """Share of each feature in the gain of all splits."""
        inner = self.nodes[self.nodes["feature"] >= 0]
        gains = np.bincount(inner["feature"], inner["gain"], self.getOrDefault(self.size))
        return Vectors.dense(gains / gains.sum() if gains.sum() else gains)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = lambda name: self.getOrDefault(self.getParam(name))
        margin = margin_udf(self.nodes, get("start"))(vector_to_array(get("featuresCol")))
        m = F.col("__margin")
        p = 1 / (1 + F.exp(-m))
        return (
            dataset.withColumn("__margin", margin)
            .withColumns(
                {
                    get("rawPredictionCol"): array_to_vector(F.array(-m, m)),
                    get("probabilityCol"): array_to_vector(F.array(1 - p, p)),
                    get("predictionCol"): (m > 0).cast("double"),
                }
            )
            .drop("__margin")
        )

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)
