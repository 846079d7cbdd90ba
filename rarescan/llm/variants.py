"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

A word is a point: how often it has each letter.  One replaced letter moves the point one
up and one down, an inserted letter one up, a deleted one one down; so a word looks for
its neighbours in the trees of its own length, of the next and of the last.

The upper part of a length's tree is fitted on a bounded sample and only deals the
words out into cells; each word is a point of one cell and a query in every cell whose
box it can reach, so the result is the same for any tree.  In a cell a tree is
built over the distinct points, the queries go down it all at once and boxes out of
reach are pruned.  Letter order is verified per pair of points by hashes of the words
without one letter, in time linear in the words of both, and then letter by letter.

A cell with many points is cut into pages, one with many queries into slices; a task
works on one page and one slice, so it stays bounded whatever the words are.

Defined cases: a null or empty text has no words; repeated rows count again; an empty
table has no words; a deleted letter may leave a word empty, which is too short to be
kept; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarescan.sources.shared import materialize

from .common import bounded_batches, narrow

# what lies between runs of letters once A-Z are lower-cased
NOT_A_RUN = "[^a-z\u00c0-\u00ff]+"
LONG_RUN = 64  # bytes
LETTERS = 26 + 64
COUNTED = 200_000  # distinct words a task holds before it passes their counts on
SAMPLE = 50_000  # words of a length that its upper tree is fitted on
POINTS = 4096  # words of a cell that a task holds
QUERIES = 16 * POINTS
MOST_CELLS = 1 << 14  # per length
LEAF = 32  # points of a leaf inside a cell
POINT, QUERY = 0, 1

CELL = "length int, leaf int, role tinyint, word string, n bigint"
NEAR = "word string, n_near bigint, best struct<less bigint, word string>"


# ---- words --------------------------------------------------------------------------


def _misspelt(word: str, number: int) -> str:
    at = number % len(word)
    return word[:at] + word[at + 1 :]


def _crc_table() -> np.ndarray:
    empty = 0xFFFFFFFF
    return np.array([zlib.crc32(bytes([i]), empty) ^ empty for i in range(256)], np.uint32)


class Numbers:
    """crc32 of ``<doc_id>:<run>`` for all runs of a batch, from one crc32 per document and per word.

    crc32 is linear: that of two strings in a row is that of the first, moved by the
    length of the second, xor that of the second.
    """

    def __init__(self, docs: list, words: list[bytes]):
        self.docs, self.words = docs, words
        table = _crc_table()
        state = np.array([zlib.crc32(self._start(i)) for i in range(len(docs))], np.uint32)
        self.moved = [state]
        for _ in range(LONG_RUN):
            state = (state >> 8) ^ table[state & 0xFF]
            self.moved.append(state)
        self.moved = np.stack(self.moved)
        self.own = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.size = np.array([len(w) for w in words], np.int64)

    def _start(self, doc: int) -> bytes:
        return f"{'' if self.docs[doc] is None else self.docs[doc]}:".encode()

    def of(self, doc: np.ndarray, word: np.ndarray) -> np.ndarray:
        size = self.size[word]
        out = self.moved[np.minimum(size, LONG_RUN), doc] ^ self.own[word]
        for i in np.nonzero(size > LONG_RUN)[0]:
            out[i] = zlib.crc32(self.words[word[i]], zlib.crc32(self._start(doc[i])))
        return out


def _runs(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The runs of all texts, and the row that each lies in."""
    only = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), NOT_A_RUN, " ")
    parts = pc.split_pattern(only, " ")
    row = np.repeat(np.arange(len(parts)), pc.list_value_length(parts).to_numpy())
    runs = parts.flatten()
    there = pc.not_equal(runs, "")
    return runs.filter(there).dictionary_encode(), row[np.asarray(there)]


def _count(batches: Iterator[pa.RecordBatch], edit_every: int) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        counts.clear()
        return pa.record_batch(columns, ["word", "n"])

    for batch in batches:
        runs, row = _runs(batch["text"])
        word = np.asarray(runs.indices)
        words = runs.dictionary.to_pylist()
        number = np.bincount(word, minlength=len(words))
        if edit_every and len(word):
            crc = Numbers(batch["doc_id"].to_pylist(), [w.encode() for w in words]).of(row, word)
            for i in np.nonzero(crc % edit_every == 0)[0].tolist():
                number[word[i]] -= 1
                counts[_misspelt(words[word[i]], int(crc[i]))] += 1
        for w, n in zip(words, number.tolist()):
            if n:
                counts[w] += n
        if len(counts) > COUNTED:
            yield flush()
    if counts:
        yield flush()


def word_counts(docs: DataFrame, edit_every: int = 0) -> DataFrame:
    """(word, n) of all runs of letters, A-Z lower-cased.

    With ``edit_every``, runs whose crc32 of ``<doc_id>:<run>`` it divides lose one letter.
    """
    texts = bounded_batches(narrow(docs, doc_id="bigint", text="string"))
    found = texts.mapInArrow(lambda batches: _count(batches, edit_every), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


# ---- trees --------------------------------------------------------------------------


def _letters(words: pa.Array) -> np.ndarray:
    """Numbers of letters, one row per word; all words have the same length."""
    code = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    code = code.reshape(len(words), -1)
    return np.where(code < 0xC0, code - 97, code - 0xC0 + 26).astype(np.uint8)


def _points(letters: np.ndarray) -> np.ndarray:
    """Letter counts, one row per word."""
    rows = len(letters)
    flat = (np.arange(rows)[:, None] * LETTERS + letters).ravel()
    return np.bincount(flat, minlength=rows * LETTERS).reshape(rows, LETTERS).astype(np.int32)


def _split(points: np.ndarray) -> tuple[int, int] | None:
    """The letter and the count that divide the points best: up to it left, above it right."""
    letter = int(points.var(axis=0).argmax())
    column = np.sort(points[:, letter])
    if column[0] == column[-1]:
        return None
    middle = column[(len(column) - 1) // 2]
    return letter, int(middle if middle < column[-1] else column[0])


class Box:
    """What queries need to move up and down, letter by letter, to reach a box.

    The box only shrinks on the way down a tree, so one letter's share changes at a time.
    """

    def __init__(self, points: np.ndarray, up: int, down: int):
        self.points, self.most_up, self.most_down = points, up, down

    def start(self):
        rows = len(self.points)
        letters = self.points.shape[1]
        low, high = np.zeros(letters, np.int32), np.full(letters, np.iinfo(np.int32).max)
        return np.arange(rows), np.zeros(rows, np.int32), np.zeros(rows, np.int32), low, high

    def below(self, state, letter: int, cut: int, right: bool):
        rows, up, down, low, high = state
        have = self.points[rows, letter]
        if right:
            low, old = low.copy(), low[letter]
            low[letter] = cut + 1
            up = up + np.maximum(cut + 1 - have, 0) - np.maximum(old - have, 0)
        else:
            high, old = high.copy(), high[letter]
            high[letter] = cut
            down = down + np.maximum(have - cut, 0) - np.maximum(have - old, 0)
        near = (up <= self.most_up) & (down <= self.most_down)
        return rows[near], up[near], down[near], low, high


def fit_cells(points: np.ndarray, share: float, size: int = POINTS) -> list | int:
    """Nested [letter, cut, left, right], leaves numbered; ``share`` of the words were sampled."""
    number = iter(range(1 << 30))

    def grow(rows: np.ndarray, depth: int):
        split = _split(points[rows]) if len(rows) > max(1, size * share) else None
        if split is None or 1 << depth >= MOST_CELLS:
            return next(number)
        letter, cut = split
        right = points[rows, letter] > cut
        return [letter, cut, grow(rows[~right], depth + 1), grow(rows[right], depth + 1)]

    return grow(np.arange(len(points)), 0)


def homes(tree, points: np.ndarray) -> np.ndarray:
    """The leaf of each point."""
    out = np.zeros(len(points), np.int32)

    def go(node, rows):
        if isinstance(node, int):
            out[rows] = node
        elif len(rows):
            letter, cut, left, right = node
            above = points[rows, letter] > cut
            go(left, rows[~above])
            go(right, rows[above])

    go(tree, np.arange(len(points)))
    return out


def reached(tree, points: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of each leaf a point reaches by so many letters up and down."""
    box, found = Box(points, up, down), []

    def go(node, state):
        if not len(state[0]):
            return
        if isinstance(node, int):
            found.append((state[0], np.full(len(state[0]), node, np.int32)))
            return
        letter, cut, left, right = node
        go(left, box.below(state, letter, cut, False))
        go(right, box.below(state, letter, cut, True))

    go(tree, box.start())
    if not found:
        return np.zeros(0, int), np.zeros(0, np.int32)
    return np.concatenate([r for r, _ in found]), np.concatenate([n for _, n in found])


# Letters up and down from a word to its neighbours: shorter by one, as long, longer by one.
MOVES = {-1: (0, 1), 0: (1, 1), 1: (1, 0)}


def _deal(batches: Iterator[pa.RecordBatch], trees: dict) -> Iterator[pa.RecordBatch]:
    """Each word once as a point of its own cell, and as a query in all cells it reaches."""
    for batch in batches:
        lengths = np.asarray(batch["length"])
        for length in np.unique(lengths).tolist():
            part = batch.filter(pa.array(lengths == length))
            points = _points(_letters(part["word"]))
            dealt = [(length, POINT, np.arange(len(points)), homes(trees.get(length, 0), points))]
            for more, (up, down) in MOVES.items():
                rows, leaves = reached(trees.get(length + more, 0), points, up, down)
                dealt.append((length + more, QUERY, rows, leaves))
            for other, role, rows, leaves in dealt:
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(rows), other, np.int32)),
                        pa.array(leaves, pa.int32()),
                        pa.array(np.full(len(rows), role, np.int8)),
                        part["word"].take(pa.array(rows)),
                        part["n"].take(pa.array(rows)),
                    ],
                    ["length", "leaf", "role", "word", "n"],
                )


# ---- search in a cell -----------------------------------------------------------------

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def _powers(count: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.full(count, BASE)]).cumprod(dtype=np.uint64)


def _whole(letters: np.ndarray) -> np.ndarray:
    terms = (letters.astype(np.uint64) + np.uint64(1)) * _powers(letters.shape[1])[:-1]
    return terms.sum(axis=1, dtype=np.uint64)


def _without(letters: np.ndarray, close: bool) -> np.ndarray:
    """Hash of each word without each letter; ``close``: what follows moves up one place."""
    terms = (letters.astype(np.uint64) + np.uint64(1)) * _powers(letters.shape[1])[:-1]
    done = terms.cumsum(axis=1, dtype=np.uint64)
    rest = done[:, -1:] - done
    if close:
        return done - terms + rest * INVERSE
    place = np.arange(letters.shape[1], dtype=np.uint64)
    return _mix(done - terms + rest + _mix(place + np.uint64(1)))


def _ranges(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and element of all ranges, one after the other."""
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return owner, starts[owner] + np.arange(len(owner)) - first[owner]


def _matches(left_pair, left_key, right_pair, right_key):
    """Rows of both sides with the same pair and key."""
    left = _mix(left_key + _mix(left_pair.astype(np.uint64)))
    right = _mix(right_key + _mix(right_pair.astype(np.uint64)))
    order = np.argsort(right, kind="stable")
    first = np.searchsorted(right[order], left, "left")
    last = np.searchsorted(right[order], left, "right")
    rows, at = _ranges(first, last - first)
    return rows, order[at]


def _unary(points: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Each count as so many bits of the ``most`` its letter has, in numbers of 64 bits."""
    bits = [points[:, letter] > i for letter in np.nonzero(most)[0] for i in range(most[letter])]
    bits += [np.zeros(len(points), bool)] * (-len(bits) % 64)
    return np.packbits(np.stack(bits, axis=1), axis=1).view(np.uint64)


class Side:
    """Words of one length as letters, and their distinct points with the words of each."""

    def __init__(self, letters: np.ndarray, counts: np.ndarray, most: np.ndarray):
        self.letters = letters
        bits = _unary(counts, most)
        self.order = np.lexsort(bits.T)
        bits = bits[self.order]
        new = np.concatenate([[True], (bits[1:] != bits[:-1]).any(axis=1)])
        self.starts = np.nonzero(new)[0]
        self.sizes = np.diff(np.append(self.starts, len(letters)))
        self.points, self.bits = counts[self.order[self.starts]], bits[self.starts]

    def of(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pair, word) for all words of each pair's point."""
        pair, at = _ranges(self.starts[points], self.sizes[points])
        return pair, self.order[at]


def near_points(points: Side, queries: Side, up: int, down: int):
    """(query, point) pairs that so many letters up and down lead from one to the other.

    The lengths fix up - down, so the letters up alone are counted in a leaf.
    """
    box, found = Box(queries.points, up, down), []

    def go(rows, state):
        if not len(rows) or not len(state[0]):
            return
        split = _split(points.points[rows]) if len(rows) > LEAF else None
        if split is None:
            lacking = np.ascontiguousarray(~queries.bits[state[0]].T)
            for at in rows.tolist():  # a leaf's few points, all queries at once
                # 8 bits may run over; a false hit does not pass the letter order
                more = np.bitwise_count(lacking[0] & points.bits[at, 0])
                for part, bits in zip(lacking[1:], points.bits[at, 1:]):
                    more += np.bitwise_count(part & bits)
                hit = state[0][more == up]
                found.append((hit, np.full(len(hit), at)))
            return
        letter, cut = split
        right = points.points[rows, letter] > cut
        go(rows[~right], box.below(state, letter, cut, False))
        go(rows[right], box.below(state, letter, cut, True))

    go(np.arange(len(points.points)), box.start())
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate([q for q, _ in found]), np.concatenate([p for _, p in found])


def _same(a: np.ndarray, b: np.ndarray, shorter: int) -> np.ndarray:
    """Whether two words differ by one letter exactly; ``shorter``: of a against b."""
    if shorter == 0:
        return (a != b).sum(axis=1) == 1
    if shorter < 0:
        a, b = b, a
    size = a.shape[1]
    head = np.cumprod(a == b[:, :size], axis=1).sum(axis=1)
    tail = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= size


def near_words(point_words: pa.Array, query_words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(query word, point word) pairs that one edit leads from one to the other."""
    letters = [_letters(words) for words in (query_words, point_words)]
    longer = letters[1].shape[1] - letters[0].shape[1]
    counts = [_points(x) for x in letters]
    most = np.maximum(counts[0].max(axis=0), counts[1].max(axis=0))
    sides = queries, points = [Side(x, c, most) for x, c in zip(letters, counts)]
    edits = MOVES[longer]
    near = near_points(points, queries, *edits)
    step = points.points[near[1]] - queries.points[near[0]]
    sought = []
    for side, own, edit, letter in zip(sides, near, edits[::-1], (step.argmin(1), step.argmax(1))):
        pair, word = side.of(own)
        if edit:  # without one letter of the kind it gives up, each place in turn
            row, place = np.nonzero(side.letters[word] == letter[pair][:, None])
            keys = _without(side.letters, close=longer != 0)[word[row], place]
            sought.append((pair[row], word[row], keys))
        else:
            sought.append((pair, word, _whole(side.letters)[word]))
    (left_pair, left, left_key), (right_pair, right, right_key) = sought
    i, j = _matches(left_pair, left_key, right_pair, right_key)
    left, right = np.divmod(np.unique(left[i] * len(point_words) + right[j]), len(point_words))
    true = _same(letters[0][left], letters[1][right], longer)
    return left[true], right[true]


def _search(table: pa.Table) -> pa.Table:
    """Neighbours of a cell's queries among its points, one row per query that has any."""
    role = np.asarray(table["role"])
    words = table["word"].combine_chunks()
    own = words.filter(pa.array(role == POINT))
    number = np.asarray(table["n"])[role == POINT]
    out: dict[str, list] = {"word": [], "n_near": [], "less": [], "best": []}
    asking = words.filter(pa.array(role == QUERY))
    if len(own) and len(asking):
        text = np.array(own.to_pylist(), object)
        rank = np.empty(len(text), np.int64)
        rank[np.lexsort((text, -number))] = np.arange(len(text))
        lengths = np.asarray(pc.utf8_length(asking))
        for length in np.unique(lengths):
            part = asking.filter(pa.array(lengths == length))
            q, p = near_words(own, part)
            order = np.lexsort((rank[p], q))
            q, p = q[order], p[order]
            asked, first, count = np.unique(q, return_index=True, return_counts=True)
            best = p[first]
            out["word"] += part.take(pa.array(asked)).to_pylist()
            out["n_near"] += count.tolist()
            out["less"] += (-number[best]).tolist()
            out["best"] += text[best].tolist()
    best = pa.StructArray.from_arrays(
        [pa.array(out["less"], pa.int64()), pa.array(out["best"], pa.string())], ["less", "word"]
    )
    return pa.table(
        [pa.array(out["word"], pa.string()), pa.array(out["n_near"], pa.int64()), best],
        ["word", "n_near", "best"],
    )


# ---- all words ------------------------------------------------------------------------


def _trees(words: DataFrame, sample: int, size: int) -> dict:
    """Upper trees of the lengths with more words than a cell has."""
    counts = words.groupBy("length").count().where(F.col("count") > size).collect()
    trees = {}
    for length, count in sorted(counts):
        share = min(1.0, sample / count)
        chosen = words.where(F.col("length") == length)
        if share < 1:
            cut = int(share * (1 << 63))
            chosen = chosen.where(F.xxhash64("word").bitwiseAND((1 << 63) - 1) < cut)
        rows = chosen.select("word").toArrow()["word"].combine_chunks()
        if len(rows):
            trees[length] = fit_cells(_points(_letters(rows)), len(rows) / count, size)
    return trees


def neighbours(words: DataFrame, sample: int = SAMPLE, size: int = POINTS) -> DataFrame:
    """(word, n_near, form, form_n) of the words (word, n) with a neighbour."""
    words = materialize(words.withColumn("length", F.char_length("word")), "words")
    trees = _trees(words, sample, size)
    dealt = words.mapInArrow(lambda batches: _deal(batches, trees), CELL)
    dealt = materialize(dealt, "cells")
    cell = ["length", "leaf"]
    count = lambda role: F.count(F.when(F.col("role") == role, 1))
    parts = dealt.groupBy(*cell).agg(
        F.ceil(count(POINT) / size).alias("pages"), F.ceil(count(QUERY) / (16 * size)).alias("slices")
    )
    sized = dealt.join(parts.where("pages > 0 AND slices > 0"), cell)
    of = lambda salt, parts: F.pmod(F.xxhash64("word", F.lit(salt)), F.col(parts))
    every = lambda parts: F.sequence(F.lit(0).cast("long"), F.col(parts) - 1)
    point = F.col("role") == POINT
    sized = sized.withColumn("page", F.explode(F.when(point, F.array(of(1, "pages"))).otherwise(every("pages"))))
    sized = sized.withColumn("slice", F.explode(F.when(point, every("slices")).otherwise(F.array(of(2, "slices")))))
    found = sized.groupBy(*cell, "page", "slice").applyInArrow(_search, NEAR)
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return near.select(
        "word", "n_near", F.col("best.word").alias("form"), (-F.col("best.less")).alias("form_n")
    )


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of forms (word, form): the last of each chain of at most ``steps`` forms."""
    found = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(steps, 1))))):
        found = materialize(found, "roots")
        on = found.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        found = found.join(on, F.col("root") == F.col("_word"), "left").select(
            "word", F.coalesce("_root", "root").alias("root")
        )
    return found


def group(
    docs: DataFrame, least_n: int = 5, least_length: int = 6, factor: int = 5, edit_every: int = 0
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words long and frequent enough.

    A word's form is its most frequent neighbour, if that is ``factor`` times as frequent.
    """
    counted = word_counts(docs, edit_every)
    kept = (F.col("n") >= least_n) & (F.char_length("word") >= least_length)
    words = materialize(counted.where(kept), "counts")
    near = neighbours(words).withColumnRenamed("form_n", "_form_n")
    has = F.col("_form_n") >= factor * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word",
        F.when(has, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("_form_n")).alias("form_n"),
    )
    joined = materialize(joined, "forms")
    most = words.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(most / least_n, factor))) if most > least_n else 1
    last = roots(joined.where("form IS NOT NULL"), steps)
    rooted = joined.join(last, "word", "left")
    return rooted.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
