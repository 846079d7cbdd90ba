"""Benchmark decontamination: word pair seeds, then Smith-Waterman alignment.

The benchmark is the stated query set; it is read in blocks of a bounded number
of words and each block is held against all whole documents.  Seeds lose no match:
an alignment with m matches and e edits scores 2m - e, so at ``least`` of an item's
perfect 2L it has e <= 2(m - least L), and of its m - 1 pairs of neighbouring matches
at most e / 2 have more than one edit between them.  So ``needed`` = least L - 1 pairs
or more (rounded up) have at most one: both words are neighbours or one place further
apart, in the item and in the document.  A first pass counts in how many documents each
pair occurs; an item's ``needed`` - 1 most frequent places seed nothing, as one of the
others must be met.  The second pass takes the words around each seed met, keeps
what holds ``needed`` pairs of any frequency near each other, and aligns the item with
it.  Frequencies choose the work, never the result.  The score is the local alignment's
share of the item's perfect score, so edited, cut and paraphrased copies score by how
much of the item, in order, is left.

Words are runs of letters, digits and underscores, lowered; in scripts written without
spaces every letter is a word.  Defined cases: a null or empty text matches nothing; an
item of fewer than ``ITEM_WORDS`` words cannot be told from chance inside other text: with
``short`` it is found, at score 1, where a line of a document has its words and no other,
else it is left out; a match shares one pair at least, whatever ``least``;
repeated items and documents are matched each; without a benchmark nothing matches;
further columns of documents are kept.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, free_unused, narrow

ITEM_WORDS = 4
LEAST_SCORE = 0.5
BLOCK_WORDS = 500_000
CHUNK = 1 << 20
HITS = 4096  # places of seeds that are widened to items at a time
MATCH, MISMATCH, GAP = 2, -1, 1

# Blocks of scripts that put no spaces between words (Thai and Lao, Myanmar, Khmer,
# ideographic marks, kana, ideographs, their compatibility forms, half-width kana, supplements).
UNSPACED = "\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3005-\u3007\u3041-\u30FF\u31F0-\u31FF" + (
    "\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uFF66-\uFF9F\U00020000-\U0003FFFF"
)
SPACED_WORD = re.compile(r"\w+")
WORD = re.compile(rf"[^\W{UNSPACED}]+|(?=\w)[{UNSPACED}]")
ANY_UNSPACED = re.compile(f"[{UNSPACED}]")


def words_of(text: str | None) -> Iterator[list[str]]:
    """The words of a whole text, some at a time."""
    text = text or ""
    word = SPACED_WORD if text.isascii() or not ANY_UNSPACED.search(text) else WORD
    at = 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and (text[end].isalnum() or text[end] == "_"):
            end += 1
        yield word.findall(text[at:end].lower())
        at = end


def needed(size: int, least: float) -> int:
    """How many places of an item of ``size`` words a match meets at least."""
    return max(1, math.ceil(least * size - 1e-9) - 1)


def pairs_of(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a word and the next, or the one after, and their keys; 0 is no word."""
    places, keys = [], []
    for step in (1, 2):
        at = np.flatnonzero((ids[:-step] > 0) & (ids[step:] > 0))
        places.append(at)
        keys.append(ids[at] * base + ids[at + step])
    return np.concatenate(places), np.concatenate(keys)


def alignment(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Best local score of two word sequences, and where in the window it ends.

    Row by row; a gap within the row is a running maximum of the row itself.
    """
    slope = GAP * np.arange(len(window) + 1)
    above = np.zeros(len(window) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        row = above - GAP
        diagonal = above[:-1] + np.where(window == word, MATCH, MISMATCH)
        row[1:] = np.maximum(row[1:], diagonal)
        row = np.maximum(row, 0)
        row = np.maximum.accumulate(row + slope) - slope
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        above = row
    return best, end


class Block:
    """Some benchmark items, and what of a document is like them."""

    def __init__(self, items: list[tuple[int | None, list[str]]]):
        self.short: dict[tuple[str, ...], list[int | None]] = defaultdict(list)
        for item_id, words in items:
            if len(words) < ITEM_WORDS:
                self.short[tuple(words)].append(item_id)
        items = [(item_id, words) for item_id, words in items if len(words) >= ITEM_WORDS]
        self.vocabulary: dict[str, int] = {}
        number = self.vocabulary.setdefault
        self.items = [
            (item_id, np.array([number(w, len(self.vocabulary) + 1) for w in words], np.int64))
            for item_id, words in items
        ]
        self.base = len(self.vocabulary) + 1
        pairs = [pairs_of(ids, self.base) for _, ids in self.items]
        self.pairs = [np.unique(keys) for _, keys in pairs]
        none = [np.zeros(0, np.int64)]
        self._seed(
            np.concatenate([keys for _, keys in pairs] or none),
            np.repeat(np.arange(len(pairs)), [len(keys) for _, keys in pairs]),
            np.concatenate([at for at, _ in pairs] or none),
        )

    def _seed(self, keys: np.ndarray, items: np.ndarray, places: np.ndarray) -> None:
        """Keys that are looked for, and per key the items and places they stand for."""
        order = np.argsort(keys, kind="stable")
        self.keys, starts = np.unique(keys[order], return_index=True)
        self.starts = np.append(starts, len(keys))
        self.of_item, self.at = items[order], places[order]

    def ids(self, text: str | None) -> np.ndarray:
        """Word numbers of a whole text, 0 for words of no item."""
        known = self.vocabulary.get
        parts = [np.fromiter((known(w, 0) for w in ws), np.int64, len(ws)) for ws in words_of(text)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs that are in ``keys``, and which they are."""
        places, keys = pairs_of(ids, self.base)
        if not len(self.keys):
            return places[:0], places[:0]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = np.flatnonzero(self.keys[at] == keys)
        return places[found], at[found]

    def keep_rare(self, frequency: np.ndarray, least: float) -> None:
        """Leave out the ``needed`` - 1 most frequent places of each item, by the frequency of each key."""
        counts = np.repeat(frequency, np.diff(self.starts))
        keys = np.repeat(self.keys, np.diff(self.starts))
        sizes = np.array([len(ids) for _, ids in self.items])
        begins = np.cumsum(sizes) - sizes
        place = begins[self.of_item] + self.at
        weight = np.bincount(place, counts, sizes.sum())
        keep = np.ones(len(weight), bool)
        for begin, size in zip(begins.tolist(), sizes.tolist(), strict=True):
            often = np.argsort(-weight[begin : begin + size - 1], kind="stable")
            keep[begin + often[: needed(size, least) - 1]] = False
        rows = keep[place]
        self._seed(keys[rows], self.of_item[rows], self.at[rows])

    def windows(self, ids: np.ndarray, least: float) -> dict[int, list[list[int]]]:
        """Per item the words around the seeds met, wide enough for a match's insertions."""
        spans: dict[int, list[list[int]]] = defaultdict(list)
        places, which = self.hits(ids)
        order = np.argsort(places, kind="stable")
        for cut in range(0, len(order), HITS):
            some = order[cut : cut + HITS]
            counts = self.starts[which[some] + 1] - self.starts[which[some]]
            shift = self.starts[which[some]] - np.cumsum(counts) + counts
            rows = np.arange(counts.sum()) + np.repeat(shift, counts)
            begins = np.repeat(places[some], counts) - self.at[rows]
            for n, begin in zip(self.of_item[rows].tolist(), begins.tolist(), strict=True):
                size = len(self.items[n][1])
                slack = _edits(size, least)
                lo, hi = max(0, begin - slack), min(len(ids), begin + size + slack)
                mine = spans[n]
                if mine and lo <= mine[-1][1] and mine[-1][0] <= hi:
                    mine[-1][0] = min(mine[-1][0], lo)
                    mine[-1][1] = max(mine[-1][1], hi)
                else:
                    mine.append([lo, hi])
        return spans

    def dense(self, n: int, window: np.ndarray, least: float) -> list[tuple[int, int]]:
        """Parts of a window with enough pairs of the item for a match, which lies in one of them."""
        size = len(self.items[n][1])
        width, count = size + _edits(size, least), needed(size, least)
        places, keys = pairs_of(window, self.base)
        at = np.minimum(np.searchsorted(self.pairs[n], keys), len(self.pairs[n]) - 1)
        good = np.unique(places[self.pairs[n][at] == keys])
        first, last = good[: max(0, len(good) - count + 1)], good[count - 1 :]
        near = last - first < width
        parts: list[tuple[int, int]] = []
        for a, b in zip(first[near].tolist(), last[near].tolist(), strict=True):
            lo, hi = max(0, b - width), min(len(window), a + width)
            if parts and lo <= parts[-1][1]:
                parts[-1] = (parts[-1][0], hi)
            else:
                parts.append((lo, hi))
        return parts

    def lines(self, text: str | None) -> list[tuple[int | None, float, int, int]]:
        """The short items that are all the words of a line, at the first such line of the text."""
        first: dict[tuple[str, ...], int] = {}
        begin = 0
        for line in (text or "").split("\n") if self.short else ():
            words = [w for some in words_of(line) for w in some]
            if len(words) < ITEM_WORDS and tuple(words) in self.short:
                first.setdefault(tuple(words), begin)
            begin += len(words)
        return [
            (item_id, 1.0, at, at + len(words)) for words, at in first.items() for item_id in self.short[words]
        ]

    def found(self, text: str | None, least: float) -> list[tuple[int | None, float, int, int]]:
        """Like ``matches``, short items included, with the items' ids."""
        long = [(self.items[n][0], *rest) for n, *rest in self.matches(text, least)]
        return long + self.lines(text)

    def matches(self, text: str | None, least: float) -> list[tuple[int, float, int, int]]:
        """(item number, score, first word of the passage, word after its last) of each item found."""
        ids = self.ids(text) if self.items else np.zeros(0, np.int64)
        found = []
        for n, spans in self.windows(ids, least).items():
            item = self.items[n][1]
            best = (0, 0, 0)
            for lo, hi in spans:
                for begin, end in self.dense(n, ids[lo:hi], least):
                    score, stop = alignment(item, ids[lo + begin : lo + end])
                    if score > best[0]:
                        best = (score, lo + begin, lo + begin + stop)
            score, lo, hi = best
            if score >= least * MATCH * len(item) - 1e-9:
                back = alignment(item[::-1], ids[lo:hi][::-1])[1]
                found.append((n, score / (MATCH * len(item)), hi - back, hi))
        return found


def _edits(size: int, least: float) -> int:
    """How many words a match can have inserted at most, see the module's text."""
    return math.ceil(2 * size * (1 - least))


def blocks(benchmark: DataFrame, short: bool = False) -> Iterator[Block]:
    """The items in blocks of about BLOCK_WORDS words; one block at a time is on the driver."""
    items, size = [], 0
    for item_id, text in narrow(benchmark, item_id="bigint", text="string").toLocalIterator():
        words = [w for some in words_of(text) for w in some]
        if len(words) >= (1 if short else ITEM_WORDS):
            items.append((item_id, words))
            size += len(words)
        if size >= BLOCK_WORDS:
            yield Block(items)
            items, size = [], 0
    if items:
        yield Block(items)


def seeded(texts: DataFrame, block: Block, least: float):
    """The block with its rare seeds, counted over all rows of ``texts``, sent to the tasks."""
    context = texts.sparkSession.sparkContext
    if not block.items:
        return context.broadcast(block)
    whole = context.broadcast(block)  # bounded by BLOCK_WORDS

    def count(batches):
        b = whole.value
        total = np.zeros(len(b.keys), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total[np.unique(b.hits(b.ids(text))[1])] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(b.keys[at]), pa.array(total[at])], ["key", "n"])

    counts = bounded_batches(texts).mapInArrow(count, "key bigint, n bigint")
    rows = counts.groupBy("key").agg(F.sum("n").alias("n")).collect()  # pairs of the block
    frequency = np.zeros(len(block.keys), np.int64)
    frequency[np.searchsorted(block.keys, [r["key"] for r in rows])] = [r["n"] for r in rows]
    block.keep_rare(frequency, least)
    whole.unpersist()
    return context.broadcast(block)


def find(
    docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE, short: bool = False
) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word): each item a document holds."""
    texts = narrow(docs, doc_id="bigint", text="string")
    schema = "doc_id bigint, item_id bigint, score double, first_word bigint, last_word bigint"
    kinds = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
         ("first_word", pa.int64()), ("last_word", pa.int64())]
    )
    found = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark, short):
        shared = seeded(texts.select("text"), block, least)

        def run(batches, shared=shared):
            b = shared.value
            for batch in batches:
                rows = [
                    (key, *match)
                    for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                    for match in b.found(text, least)
                ]
                columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds
                )

        found = found.unionByName(bounded_batches(texts).mapInArrow(run, schema))
    return found


def remove(
    docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE, short: bool = False
) -> DataFrame:
    """The documents that hold no item of the benchmark, as they came."""
    text_at = docs.columns.index("text")
    kept = docs
    for block in blocks(benchmark, short):
        shared = seeded(docs.select(F.col("text").cast("string")), block, least)

        def run(batches, shared=shared):
            b = shared.value
            for batch in batches:
                texts = batch.column(text_at).to_pylist()
                yield batch.filter(pa.array([not b.found(t, least) for t in texts], pa.bool_()))
                del batch, texts
                free_unused()

        kept = bounded_batches(kept).mapInArrow(run, docs.schema)
    return kept
