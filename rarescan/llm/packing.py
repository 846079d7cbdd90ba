"""Packing of documents into token sequences of a fixed capacity.

Each task tokenises its own documents and packs them, so nothing is shuffled.
Whole capacities of a long document become sequences at once.  What remains of
each document is gathered until ``batch_windows`` windows are worth of tokens,
and is then divided by Karmarkar-Karp multiway differencing: every piece starts
as a partial partition of its own; the two with the largest imbalance are
merged, heavy slots on light ones, until one partition is left.  If a window
exceeds the capacity, the window count rises; if that would pad too much,
the pieces are halved first.

Defined cases: a null or empty text has the end id alone; repeated rows and
repeated or null ids are documents of their own; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import bounded_batches, free_unused, narrow

CAPACITY = 2048
END_ID = 1
BATCH_WINDOWS = 64
PADDING = 0.02  # share of padding above which pieces are halved
CACHED_PARTS = 250_000  # of a worker, which keeps them from task to task: about 40 MB
WIDTH = 4  # bytes of an id
MARK = b"\xff" * WIDTH  # no id

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)


def _classes() -> tuple[str, str]:
    """Letters and numbers up to U+024F, for a regular expression's brackets."""
    points = [chr(i) for i in range(0x250)]
    return tuple("".join(c for c in points if unicodedata.category(c)[0] == k) for k in "LN")


LETTERS, NUMBERS = _classes()
# Capitals whose small letter lies beyond those letters.
FAR_CAPITALS = "".join(c for c in map(chr, range(0x250)) if len(c.lower()) > 1 or c.lower() > "\u024f")
BLANKS = r"\t-\r \x85\xa0"
# Latin letters and general punctuation: canonical as they stand, lowered one by one.
UNUSUAL = re.compile(
    rf"[^\x00-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e\u20ac]|[{FAR_CAPITALS}]|<\|"
)
# The parts of a lowered usual text, which a word vocabulary encodes one by one, and blanks.
PARTS = re.compile(rf" |'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[^{BLANKS}{LETTERS}{NUMBERS}]+")


class Encoder:
    """Ids of texts by one word vocabulary, with parts met before looked up.

    The vocabulary lowers a text, drops white space, splits it by the pattern
    above and merges within the parts only, so a text's ids are those of its
    chunks between blanks, and these those of their parts.  Chunks with control
    strings or other scripts go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.single = Tokenizer.from_str(self.whole.to_str())
        self.single.normalizer = None
        self.single.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(False, use_regex=False)]
        )
        self.ends = {i for word, i in self.whole.get_vocab().items() if word.endswith("</w>")}
        self.parts = {" ": MARK}

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text (null: none) as unsigned little-endian 32-bit integers."""
        blank = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        chunks = pc.split_pattern(blank, " ")
        coded = chunks.flatten().dictionary_encode()
        known = pa.array(self._chunks(coded.dictionary.to_pylist()), pa.binary())
        ids = known.take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset :]
        at = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(chunks).to_numpy())])]
        data = ids.buffers()[2]
        return [data[lo:hi].to_pybytes() for lo, hi in zip(at, at[1:], strict=False)]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks, which hold neither blanks nor line ends."""
        odd = {c for c in chunks if UNUSUAL.search(c)} if UNUSUAL.search(" ".join(chunks)) else ()
        rows = " ".join(["" if c in odd else c for c in chunks] if odd else chunks)
        parts = PARTS.findall(rows.lower())
        self._learn(list(set(parts).difference(self.parts)))
        found = b"".join(map(self.parts.__getitem__, parts)).split(MARK)
        for n, chunk in enumerate(chunks) if odd else ():
            if chunk in odd:
                ids = self.whole.encode_batch_fast([chunk], add_special_tokens=False)[0].ids
                found[n] = _bytes(ids)
        return found

    def trim(self) -> None:
        """Forget the parts when they are many: a worker outlives its tasks."""
        if len(self.parts) > CACHED_PARTS:
            self.parts = {" ": MARK}

    def _learn(self, missing: list[str]) -> None:
        ids = self.single.encode_batch_fast([" ".join(missing)], add_special_tokens=False)[0].ids
        packed = _bytes(ids)
        at, ends = 0, [n for n, i in enumerate(ids, 1) if i in self.ends]
        if len(ends) != len(missing) or (ends and ends[-1] != len(ids)):
            raise ValueError("the vocabulary does not mark the end of every word")
        for part, end in zip(missing, ends, strict=True):
            self.parts[part] = packed[at * WIDTH : end * WIDTH]
            at = end


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per Python worker and file; what it has met stays for later tasks."""
    return Encoder(path)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Item numbers of each of ``windows`` near-equal windows (Karmarkar-Karp).

    A partial partition is its non-empty slots, heaviest first; the imbalance
    is the heaviest slot less the lightest, 0 while a slot is empty.
    """
    heap = [(-size, n, [(size, n)]) for n, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        overlap = len(a) + len(b) - windows
        if overlap <= 0:
            merged = a + b
        else:
            # the lightest slots of a take the lightest of b, heavy on light
            keep_a, keep_b = a[: len(a) - overlap], b[: len(b) - overlap]
            tail_a, tail_b = a[len(a) - overlap :], b[len(b) - overlap :]
            merged = keep_a + keep_b
            merged += [
                (x + y, (m, n)) for (x, m), (y, n) in zip(tail_a, reversed(tail_b), strict=True)
            ]
        merged.sort(key=lambda slot: slot[0], reverse=True)
        light = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (light - merged[0][0], serial, merged))
        serial += 1
    return [_members(tree) for _, tree in heap[0][2]] if heap else []


def _members(tree) -> list[int]:
    found, stack = [], [tree]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack.extend(node)
        else:
            found.append(node)
    return sorted(found)


def windows_of(
    pieces: list[tuple[int, int]], capacity: int, padding: float = PADDING
) -> tuple[list[tuple[int, int, int]], list[list[int]]]:
    """Cut (start, length) pieces if need be and divide them.

    Returns the final (piece number, start, length) rows and the windows.
    """
    total = sum(length for _, length in pieces)
    least = -(-total // capacity)
    most = least + max(1, int(least * padding))
    part = capacity
    while True:
        cut = []
        for n, (start, length) in enumerate(pieces):
            parts = -(-length // part)
            edges = [length * i // parts for i in range(parts + 1)]
            cut += [(n, start + lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]
        sizes = [length for _, _, length in cut]
        count = least
        while count <= most or part <= capacity // 8 or part == 1:
            found = differencing(sizes, count)
            if max(sum(sizes[i] for i in w) for w in found) <= capacity:
                return cut, found
            count += 1
        part = max(1, part // 2)


def pack_rows(rows: Iterator[tuple[int, bytes]], partition: int, capacity: int, batch_windows: int):
    """Piece rows of (doc_id, ids) rows, in lists; see SCHEMA."""
    number = partition << 33
    out: list[tuple] = []
    waiting: list[tuple[int, bytes, int, int]] = []
    tokens = 0

    def close():
        nonlocal number
        cut, found = windows_of([(w[2], w[3]) for w in waiting], capacity)
        for window in found:
            offset = 0
            for i in window:
                n, start, length = cut[i]
                doc_id, ids, first, _ = waiting[n]
                at = (start - first) * WIDTH
                out.append(
                    (doc_id, start, length, first + len(ids) // WIDTH, number, offset,
                     ids[at : at + length * WIDTH])
                )
                offset += length
            number += 1

    for doc_id, ids in rows:
        total = len(ids) // WIDTH
        whole = total // capacity * capacity
        for start in range(0, whole, capacity):
            piece = ids[start * WIDTH : (start + capacity) * WIDTH]
            out.append((doc_id, start, capacity, total, number, 0, piece))
            number += 1
        if total > whole:
            waiting.append((doc_id, ids[whole * WIDTH :], whole, total - whole))
            tokens += total - whole
        if tokens >= capacity * batch_windows:
            close()
            waiting, tokens = [], 0
        if len(out) >= 512:
            yield out
            out = []
    if waiting:
        close()
    if out:
        yield out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    batch_windows: int = BATCH_WINDOWS,
) -> DataFrame:
    """One row per piece, with its ids (unsigned little-endian 32-bit) and its place."""
    end = _bytes([end_id])
    schema = pa.schema(
        [(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")]
        + [("ids", pa.binary())]
    )

    def documents(batches):
        encode = encoder(tokenizer_path)
        for batch in batches:
            found = encode(batch.column(1))
            for key, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                yield key, ids + end
            del found
            encode.trim()
            free_unused()

    def run(batches):
        partition = TaskContext.get().partitionId()
        for rows in pack_rows(documents(batches), partition, capacity, batch_windows):
            columns = [list(c) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    source = bounded_batches(narrow(docs, doc_id="bigint", text="string"), "6m")
    return source.mapInArrow(run, SCHEMA)
