"""Katz back-off language model over all training documents, and the score of every text.

Documents are encoded once into written batches of tokens.  A batch asks for the counts of
its distinct n-grams: hashes of 64 bits, dealt by ranges of the hash space, packed.
Each range adds up all counts in one bounded task, and answers in the order asked, so an
answer is its counts alone.  From the answers a batch knows all discounted
probabilities; the back-off weights of contexts are summed over the corpus and joined to
the documents that back off.

Probabilities.  A count r becomes r* = (r + 1) n(r + 1) / n(r) up to K, by Good and Turing; above, and where
counts of counts give no r* between 0 and r, n(r) is smoothed by a power of r fitted to them.  What the
followers of a context lose goes to the words not seen after it, in proportion to their
probability in the shorter context; the weight makes all probabilities sum to 1 exactly.
At the bottom one unknown word has the mass that single words lose.

Tables: ``tokens`` (batches), ``answers`` (counts by level and range), ``scored`` (partitioned by kind:
documents, shares of contexts, uses of contexts).

Defined cases: a null or empty text is its end token; a null doc_id is a training document;
repeated rows are counted and scored each; without training tokens every word is the unknown
one, of probability 1; an empty table has no rows; other columns are ignored.  Hashes of 64 bits
make two of 10^9 words meet with a probability of 3 %; nothing checks for that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarescan.sources.shared import discard, materialize

from .common import bounded_batches, free_unused

ORDER = 2
K = 5  # counts up to this have Turing's own estimate
BATCH_BYTES = 16_000_000  # of text, about
RANGE_KEYS = 2_000_000  # n-grams asked for in one range, about
HOT = 1000  # a context of more than one in so many tokens is joined by broadcast
START, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
DOCUMENT, SHARE, USE = 0, 1, 2

TOKENS = "batch bigint, docs array<bigint>, held array<boolean>, lengths array<int>, tokens binary, words binary"
ASKED = "level int, slice int, batch bigint, size int, keys binary, counts binary, held binary"
ANSWERS = (
    "level int, slice int, batch bigint, size int, counts binary, first binary, held binary, "
    "totals array<bigint>"
)
SCORED = (
    "kind int, batch bigint, at int, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
    "base_score double, score double, level int, context bigint, size bigint, mass double, lost double, n bigint"
)


# ---- packed numbers -------------------------------------------------------------------


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the largest needs."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(data: bytes, count: int) -> np.ndarray:
    out = np.zeros((count, 8), np.uint8)
    if count:
        out[:, : len(data) // count] = np.frombuffer(data, np.uint8).reshape(count, -1)
    return out.view("<u8").ravel()


def _bits(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=count).astype(bool)


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _expand(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, "zstd", asbytes=True)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _extend(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of a context and a word after it."""
    return _mix(context * np.uint64(0x9E3779B97F4A7C15) + word)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``np.unique`` with the inverse, in 25 bytes a value (there 45)."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.ones(len(values), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    found = ordered[new]
    del ordered
    of = np.empty(len(values), np.int32)
    of[order] = np.cumsum(new, dtype=np.int32) - 1
    return found, of


# ---- documents to tokens --------------------------------------------------------------


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal number
        table = pa.Table.from_batches(held).combine_chunks()
        plain = pc.ascii_lower(pc.fill_null(table["text"].combine_chunks(), ""))
        parts = pc.split_pattern(pc.replace_substring_regex(plain, "[\t-\r]", " "), " ")
        words = parts.flatten()
        there = np.asarray(pc.not_equal(words, ""))
        rows = np.repeat(np.arange(len(parts)), pc.list_value_length(parts).to_numpy())[there]
        coded = words.filter(pa.array(there)).dictionary_encode()
        hashes = [xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()]
        hashes = np.append(np.array(hashes, np.uint64), END)
        lengths = np.bincount(rows, minlength=len(parts)) + 1
        tokens = np.full(lengths.sum(), len(hashes) - 1, np.uint32)
        within = np.ones(len(tokens), bool)
        within[np.cumsum(lengths) - 1] = False  # the end tokens
        tokens[within] = np.asarray(coded.indices)
        number += 1
        return pa.record_batch(
            [
                pa.array([number], pa.int64()),
                pa.array([table["doc_id"].to_pylist()], pa.list_(pa.int64())),
                pa.array([table["held_out"].to_pylist()], pa.list_(pa.bool_())),
                pa.array([lengths.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([_squeeze(tokens.tobytes())], pa.binary()),
                pa.array([hashes.tobytes()], pa.binary()),
            ],
            ["batch", "docs", "held", "lengths", "tokens", "words"],
        )

    for batch in batches:
        if held and size + batch.nbytes > BATCH_BYTES:
            yield flush()
            held, size = [], 0
            free_unused()
        held.append(batch)
        size += batch.nbytes
    if size:
        yield flush()
    held.clear()
    free_unused()


def encode(docs: DataFrame, held_out: Column) -> DataFrame:
    """Written batches of tokens; ``held_out`` documents are not learned from."""
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return materialize(bounded_batches(texts, "4m").mapInArrow(_encode, TOKENS), "tokens")


class Batch:
    """A batch's tokens, and its n-grams level by level."""

    def __init__(self, row: dict):
        self.number, self.docs = row["batch"], row["docs"]
        self.held = np.array(row["held"], bool)
        self.lengths = np.array(row["lengths"], np.int64)
        self.doc = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)
        starts = (np.cumsum(self.lengths) - self.lengths).astype(np.int32)
        self.place = np.arange(len(self.doc), dtype=np.int32) - starts[self.doc]
        self.word = np.frombuffer(row["words"], np.uint64)[np.frombuffer(_expand(row["tokens"]), np.uint32)]

    def before(self, level: int) -> np.ndarray:
        """Key of the ``level`` tokens before each."""
        return self._before(self.word, level)

    def grams(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys of ``level + 1`` tokens, and which of them each token ends."""
        key = _extend(self.before(level), self.word) if level else self.word
        return _distinct(key)

    def _before(self, word: np.ndarray, count: int) -> np.ndarray:
        """Key of the ``count`` tokens before each; START stands before a document."""
        key = None
        for back in range(count, 0, -1):
            one = np.full(len(word), START)
            one[back:] = word[: len(word) - back]
            one[self.place < back] = START
            key = one if key is None else _extend(key, one)
        return key

    def after(self, values: np.ndarray, start) -> np.ndarray:
        """For each token the value of the token before, ``start`` at a document's first."""
        out = np.full(len(values), start, values.dtype)
        out[1:] = values[:-1]
        out[self.place == 0] = start
        return out

    def occurrences(self, of: np.ndarray, count: int, held: bool) -> np.ndarray:
        return np.bincount(of[self.held[self.doc] == held], minlength=count)


# ---- counts -------------------------------------------------------------------------


def _slices(keys: np.ndarray, slices: int) -> Iterator[tuple[int, int, int, np.uint64]]:
    """(slice, from, to, edge) of the equal ranges of the hash space that sorted keys lie in."""
    edges = np.array([(i << 64) // slices for i in range(slices)], np.uint64)
    ends = np.append(np.searchsorted(keys, edges[1:]), len(keys)).tolist()
    for number, (lo, hi) in enumerate(zip([0, *ends], ends)):
        if hi > lo:
            yield number, lo, hi, edges[number]


def _ask(batches: Iterator[pa.RecordBatch], order: int, slices: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [(n, pa.int32()) for n in ("level", "slice")]
        + [("batch", pa.int64()), ("size", pa.int32())]
        + [(n, pa.binary()) for n in ("keys", "counts", "held")]
    )
    for row in (r for b in batches for r in b.to_pylist()):
        batch = Batch(row)
        for level in range(order):
            keys, of = batch.grams(level)
            counts = batch.occurrences(of, len(keys), False)
            held = batch.occurrences(of, len(keys), True) > 0
            rows = [
                (
                    level, number, batch.number, hi - lo,
                    _pack(np.diff(keys[lo:hi], prepend=edge)),  # steps from key to key
                    _pack(counts[lo:hi]), np.packbits(held[lo:hi]).tobytes(),
                )
                for number, lo, hi, edge in _slices(keys, slices)
            ]
            columns = zip(*rows) if rows else [[]] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            del keys, of, counts, held, rows, columns  # not beside the next level's or batch's
        del row, batch
        free_unused()


def _answer(table: pa.Table) -> pa.Table:
    """Counts over all batches, in the order each asked.

    ``first``: the batch that speaks for a key; ``held``: keys of any held-out document.
    ``totals``, in one row: tokens, distinct n-grams, and how many occur 1 to K + 1 times.
    """
    table = table.sort_by("batch")
    sizes = table["size"].to_pylist()
    ends = np.cumsum(sizes)[:-1]
    read = lambda name, how: np.concatenate(
        [how(data, n) for data, n in zip(table[name].to_pylist(), sizes)]
    )
    # the edge of the range is left out: it is the same for all
    steps = read("keys", lambda data, n: np.cumsum(_unpack(data, n), dtype=np.uint64))
    own = read("counts", _unpack).astype(np.int64)
    keys, of = np.unique(steps, return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, of, own)
    held = np.zeros(len(keys), bool)
    held[of[read("held", _bits)]] = True
    there = np.nonzero(own)[0][::-1]
    speaker = np.full(len(keys), -1)
    speaker[of[there]] = there  # the first batch is written last
    first = speaker[of] == np.arange(len(of))
    seen = counts[counts > 0]
    times = np.bincount(np.minimum(seen, K + 2), minlength=K + 3)[1 : K + 2]
    totals = [[int(seen.sum()), len(seen), *times.tolist()]] + [None] * (len(sizes) - 1)
    split = lambda values, how: pa.array([how(v) for v in np.split(values, ends)], pa.binary())
    packed = lambda flags: np.packbits(flags).tobytes()
    columns = [table[name] for name in ("level", "slice", "batch", "size")]
    columns += [split(counts[of], _pack), split(first, packed), split(held[of], packed)]
    names = ["level", "slice", "batch", "size", "counts", "first", "held", "totals"]
    return pa.table([*columns, pa.array(totals, pa.list_(pa.int64()))], names)


# ---- probabilities --------------------------------------------------------------------


@dataclass(frozen=True)
class Level:
    """Totals of the n-grams of one length: tokens, distinct ones, and how many occur 1 to K + 1 times."""

    tokens: int = 0
    distinct: int = 0
    times: tuple[int, ...] = (0,) * (K + 1)

    def slope(self) -> float:
        """Of the power that n(r) falls by, at most -1.1 so that every count loses some."""
        points = [(math.log(r), math.log(n)) for r, n in enumerate(self.times, 1) if n]
        if len(points) < 2:
            return -2.0
        x, y = np.array(points).T
        return min(float(np.polyfit(x, y, 1)[0]), -1.1)

    def keeps(self, counts: np.ndarray) -> np.ndarray:
        """r*/r of each count; 0 has 0."""
        r = np.maximum(counts, 1).astype(np.float64)
        out = (1 + 1 / r) ** (self.slope() + 1)
        if all(self.times):
            low = np.arange(1, K + 1)
            turing = (low + 1) * np.array(self.times[1:]) / (low * np.array(self.times[:K]))
            if (turing < 1).all():
                out = np.where(counts <= K, turing[np.clip(counts, 1, K) - 1], out)
        return np.where(counts > 0, out, 0.0)

    def reduced(self, counts: np.ndarray) -> np.ndarray:
        return counts * self.keeps(counts)

    def lost(self, counts: np.ndarray) -> np.ndarray:
        return counts * (1 - self.keeps(counts))


def _lost(batches: Iterator[pa.RecordBatch], words: Level) -> Iterator[pa.RecordBatch]:
    """What the words a batch speaks for lose."""
    for row in (r for b in batches for r in b.to_pylist()):
        counts = _unpack(row["counts"], row["size"]).astype(np.int64)
        lost = words.lost(counts[_bits(row["first"], row["size"])]).sum()
        yield pa.record_batch([pa.array([lost], pa.float64())], ["lost"])


# ---- scores ---------------------------------------------------------------------------


def _rows(kind: int, **columns) -> pa.Table:
    """Rows of SCORED, other columns null."""
    count = max(len(c) for c in columns.values() if hasattr(c, "__len__"))
    fields = []
    for part in SCORED.split(", "):
        name, spec = part.split()
        spec = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[spec]
        value = kind if name == "kind" else columns.get(name)
        if not hasattr(value, "__len__"):
            value = [value] * count
        fields.append(pa.field(name, spec).with_metadata(None))
        columns[name] = pa.array(value, spec)
    return pa.table([columns[f.name] for f in fields], pa.schema(fields))


def _score(
    tokens: pa.Table, answers: pa.Table, levels: Sequence[Level], unknown: float, documents: int, slices: int
) -> pa.Table:
    """What a batch knows: its documents' scores but for weights, its shares of the contexts whose
    n-grams it speaks for, and the contexts whose weights its documents need."""
    (row,) = tokens.to_pylist()
    batch = Batch(row)
    grams = [batch.grams(level) for level in range(len(levels))]
    keys_of, token_of = [keys for keys, _ in grams], [of for _, of in grams]
    given = {(r["level"], r["slice"]): r for r in answers.to_pylist()}

    def read(level, name, how):
        parts = [given[level, n] for n, *_ in _slices(keys_of[level], slices)]
        return np.concatenate([how(r[name], r["size"]) for r in parts])

    counts = [read(level, "counts", _unpack).astype(np.int64) for level in range(len(levels))]
    words, seen = levels[0], counts[0][token_of[0]]
    known = seen > 0
    total = lambda values: np.bincount(batch.doc, values, len(batch.lengths))
    base = total(np.log10((seen + 1) / (words.tokens + words.distinct + 1)))
    n_known = total(known).astype(np.int64)
    value = words.reduced(counts[0]) / max(words.tokens, 1)  # of each distinct n-gram
    log = np.log10(np.where(known, value[token_of[0]], unknown))
    out = []
    for level in range(1, len(levels)):
        own, of_key = levels[level], token_of[level]
        size = batch.after(seen, documents)  # how often the context occurs
        wanted = batch.after(read(level - 1, "held", _bits)[token_of[level - 1]], True)
        seen = counts[level][of_key]
        contexts, of = _distinct(batch.before(level))
        one = np.empty(len(keys_of[level]), np.int32)  # a token of each distinct n-gram, its first
        one[of_key[::-1]] = np.arange(len(of_key) - 1, -1, -1, dtype=np.int32)
        # each n-gram of the corpus once, where a held-out document may back off
        said = one[read(level, "first", _bits) & wanted[one]]
        add = lambda values: np.bincount(of[said], values, len(contexts))
        mass, lost = add(value[token_of[level - 1][said]]), add(own.lost(seen[said]))
        sizes = np.zeros(len(contexts), np.int64)
        sizes[of] = size
        some = lost > 0
        out.append(
            _rows(
                SHARE, level=level, context=contexts[some].view(np.int64), size=sizes[some],
                mass=mass[some], lost=lost[some],
            )
        )
        backs = (seen == 0) & (size > 0)
        del wanted, said
        pair, n = np.unique(batch.doc[backs].astype(np.int64) * len(contexts) + of[backs], return_counts=True)
        doc, context = np.divmod(pair, len(contexts))
        out.append(
            _rows(
                USE, batch=batch.number, at=doc, level=level, context=contexts[context].view(np.int64),
                size=sizes[context], n=n,
            )
        )
        value = own.reduced(counts[level]) / np.maximum(size[one], 1)
        del contexts, of, one, pair, doc, context, backs, size
        np.log10(value[of_key], where=seen > 0, out=log)  # the others keep the shorter context's
    out.append(
        _rows(
            DOCUMENT, batch=batch.number, at=np.arange(len(batch.lengths)), doc_id=batch.docs,
            held_out=batch.held, n_tokens=batch.lengths, n_known=n_known,
            base_score=base, score=total(log),
        )
    )
    return pa.concat_tables(out)


def _weights(shares: DataFrame) -> DataFrame:
    """(level, context, size, weight): log10 of what a probability in the shorter context is times."""
    whole = shares.groupBy("level", "context").agg(
        F.max("size").alias("size"), F.sum("mass").alias("mass"), F.sum("lost").alias("lost")
    )
    weight = F.log10(F.col("lost") / F.col("size") / (1 - F.col("mass")))
    return whole.select("level", "context", "size", weight.alias("weight"))


def score(docs: DataFrame, held_out: Column, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of all documents.

    Learned from those that are not ``held_out``, a column over ``docs``; n-grams of up to ``order`` tokens.
    """
    tokens = encode(docs, held_out)
    size = tokens.select(
        F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"),
        F.size(F.filter("held", lambda h: ~h)).alias("documents"),
    )
    size = size.agg(F.sum("n"), F.sum("documents")).first()
    documents, slices = size[1] or 0, 1 + (size[0] or 0) * order // RANGE_KEYS
    asked = tokens.mapInArrow(lambda batches: _ask(batches, order, slices), ASKED)
    answers = materialize(asked.groupBy("level", "slice").applyInArrow(_answer, ANSWERS), "answers")
    total = lambda i: F.sum(F.col("totals")[i])
    rows = answers.where("totals IS NOT NULL").groupBy("level").agg(*map(total, range(K + 3))).collect()
    levels = {r[0]: Level(r[1], r[2], tuple(r[3:])) for r in rows}
    levels = [levels.get(level, Level()) for level in range(order)]
    lost = answers.where("level = 0").mapInArrow(lambda batches: _lost(batches, levels[0]), "lost double")
    lost = lost.agg(F.sum("lost")).first()[0] or 0.0
    unknown = lost / levels[0].tokens if levels[0].tokens else 1.0

    def scored(tokens: pa.Table, answers: pa.Table) -> pa.Table:
        found = _score(tokens, answers, levels, unknown, documents, slices)
        free_unused()
        return found

    both = tokens.groupBy("batch").cogroup(answers.groupBy("batch"))
    found = materialize(both.applyInArrow(scored, SCORED), "scored", ("kind",))
    discard(tokens, answers)
    of_kind = lambda kind, *names: found.where(F.col("kind") == kind).select(*names)
    weights = _weights(of_kind(SHARE, "level", "context", "size", "mass", "lost"))
    uses = of_kind(USE, "batch", "at", "level", "context", "size", "n")
    hot = F.col("size") * HOT > levels[0].tokens  # at most HOT contexts of each length, and starts
    on = ["level", "context"]
    lowered = uses.where(hot).join(F.broadcast(weights.where(hot).drop("size")), on)
    lowered = lowered.unionByName(uses.where(~hot).join(weights.where(~hot).drop("size"), on))
    lowered = lowered.groupBy("batch", "at").agg(F.sum(F.col("n") * F.col("weight")).alias("weights"))
    documents = of_kind(
        DOCUMENT, "batch", "at", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"
    )
    joined = documents.join(lowered, ["batch", "at"], "left")
    return joined.select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(levels[0].tokens).cast("long").alias("train_tokens"), "base_score",
        (F.col("score") + F.coalesce("weights", F.lit(0.0))).alias("score"),
    )
