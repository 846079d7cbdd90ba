"""Language identification by sparse multinomial logistic regression.

Whole texts become counts of hashed character n-grams (one to three letters,
anything else is one blank), weighted by TF-IDF.  Document frequencies cover all
training rows.  The weights are fitted on a bounded sample, about
``sample_rows`` in all and equally many of each language: shards of it run
follow-the-regularised-leader with elastic-net penalties on their own and are
averaged; one more part of the sample, which no shard saw, sets the temperature.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is
everything when there is nothing to learn from; a null language or doc_id is not
learned from; repeated rows count each; an empty table gives no rows; ties go to the
first language in order; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, narrow

BUCKETS = 1 << 16
SAMPLE_ROWS = 12_000
SHARDS = 4  # a further part calibrates
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
CHUNK = 1 << 20  # characters at once
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _chunk_keys(x: np.ndarray, known: int) -> np.ndarray:
    """Buckets of the n-grams that end after the first ``known`` characters of x."""
    low, mid = np.uint64(21), np.uint64(42)
    one = x[known:] + np.uint64(1 << 20)
    two = (x[:-1] << low | x[1:])[max(0, known - 1) :]
    three = (x[:-2] << mid | x[1:-1] << low | x[2:])[max(0, known - 2) :]
    key = np.concatenate([one, two, three]) * np.uint64(0x9E3779B97F4A7C15)
    return (key >> np.uint64(48)).astype(np.int64)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of a whole text, chunk by chunk; empty without a letter."""
    lowered = (text or "").lower()
    letters = _letters()
    before = np.array([32], np.uint64)  # the last two characters, blanks collapsed
    found, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    dense = None
    seen = False
    for at in range(0, len(lowered), CHUNK):
        part = lowered[at : at + CHUNK].encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(part, np.uint32)
        is_letter = letters[codes]
        seen = seen or bool(is_letter.any())
        x = np.concatenate([before, np.where(is_letter, codes, 32).astype(np.uint64)])
        blank = x == 32
        keep = np.ones(len(x), bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        x = x[keep]
        keys = _chunk_keys(x, len(before))
        if len(lowered) < min(CHUNK, BUCKETS // 4):
            found, counts = np.unique(keys, return_counts=True)
        else:
            here = np.bincount(keys, minlength=BUCKETS)
            dense = here if dense is None else dense + here
        before = x[-2:]
    if not seen:
        return found[:0], counts[:0]
    if dense is not None:
        found = np.flatnonzero(dense)
        counts = dense[found]
    return found, counts


@dataclass
class Model:
    classes: list[str]
    idf: np.ndarray  # by bucket
    weights: np.ndarray  # bucket x class, the last row is the intercept
    temperature: float = 1.0

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        found, counts = grams(text)
        values = (1 + np.log(counts)) * self.idf[found]
        norm = np.sqrt((values * values).sum())
        return found, values / norm if norm else values

    def logits(self, found: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[found] + self.weights[BUCKETS]

    def predict(self, text: str | None) -> tuple[str, float]:
        found, values = self.vector(text)
        if not len(found) or not self.classes:
            return UNKNOWN, 0.0
        p = softmax(self.logits(found, values) / self.temperature)
        best = int(p.argmax())
        return self.classes[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (bucket x class) by per-coordinate FTRL-proximal with L1 and L2."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros((BUCKETS + 1, classes))

    def weights(zi, ni, l1):
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - l1, 0)
        return -shrunk / ((BETA + np.sqrt(ni)) / ALPHA + L2)

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            found, values, label = rows[i]
            at = np.append(found, BUCKETS)
            x = np.append(values, 1.0)
            zi, ni = z[at], n[at]
            w = weights(zi, ni, L1)
            error = softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[at] = zi + g - sigma * w
            n[at] = ni + g * g
    return weights(z, n, L1)


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section on its logarithm."""
    if not len(logits):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-300)).mean()

    lo, hi, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _document_frequencies(train: DataFrame) -> tuple[int, np.ndarray]:
    """Training rows with a letter, and in how many of them each bucket occurs."""
    kinds = pa.schema([("bucket", pa.int64()), ("rows", pa.int64())])

    def run(batches):
        rows = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found, _ = grams(text)
                rows[found] += 1
                rows[BUCKETS] += len(found) > 0
        at = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(rows[at])], schema=kinds)

    per_task = bounded_batches(train.select("text")).mapInArrow(run, "bucket bigint, rows bigint")
    total = np.zeros(BUCKETS + 1, np.int64)
    # at most BUCKETS + 1 rows, whatever the corpus
    for bucket, rows in per_task.groupBy("bucket").agg(F.sum("rows")).collect():
        total[bucket] = rows
    return int(total[BUCKETS]), total[:BUCKETS]


def _sample(train: DataFrame, sample_rows: int) -> tuple[list[str], DataFrame]:
    """The languages, and about equally many rows of each, by a hash of the row."""
    counts = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    classes = sorted(counts)
    quota = sample_rows / max(1, len(classes))
    share = F.lit(0.0)
    number = F.lit(0)
    for i, lang in enumerate(classes):
        share = F.when(F.col("lang") == lang, min(1.0, quota / counts[lang])).otherwise(share)
        number = F.when(F.col("lang") == lang, i).otherwise(number)
    draw = (F.xxhash64("doc_id", F.lit(17)).bitwiseAND((1 << 52) - 1)) / float(1 << 52)
    part = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(SHARDS + 1)).cast("int")
    chosen = train.where(draw < share).select("text", number.alias("label"), part.alias("part"))
    return classes, chosen


def fit(train: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from rows (doc_id, text, lang) without nulls in doc_id and lang."""
    spark = train.sparkSession
    rows, df = _document_frequencies(train)
    idf = np.log((1 + rows) / (1 + df)) + 1
    classes, chosen = _sample(train, sample_rows)
    empty = Model(classes, idf, np.zeros((BUCKETS + 1, len(classes))))
    if not classes or not rows:
        return Model([], idf, empty.weights)
    shared = spark.sparkContext.broadcast(empty)
    size = len(classes)

    def shard(table: pa.Table) -> pa.Table:
        model = shared.value
        vectors = [
            (*model.vector(t), label)
            for t, label in zip(table["text"].to_pylist(), table["label"].to_pylist(), strict=True)
        ]
        weights = ftrl([v for v in vectors if len(v[0])], size)
        at = np.flatnonzero(np.abs(weights).sum(axis=1))
        columns = [at.astype("<i4").tobytes(), weights[at].astype("<f4").tobytes(), len(vectors)]
        return pa.table({k: [v] for k, v in zip(("at", "weights", "n"), columns, strict=True)})

    shards = (
        chosen.where(F.col("part") < SHARDS)
        .groupBy("part")
        .applyInArrow(shard, "at binary, weights binary, n bigint")
        .collect()  # SHARDS rows, each bounded by buckets x languages
    )
    weights = np.zeros_like(empty.weights)
    total = sum(s["n"] for s in shards)
    for s in shards:
        at = np.frombuffer(s["at"], "<i4")
        weights[at] += np.frombuffer(s["weights"], "<f4").reshape(-1, size) * (s["n"] / max(1, total))
    shared.unpersist()
    model = Model(classes, idf, weights)
    scorer = spark.sparkContext.broadcast(model)

    def score(batches):
        m = scorer.value
        for batch in batches:
            out, labels = [], []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, values = m.vector(text)
                if len(found):
                    out.append(m.logits(found, values).tolist())
                    labels.append(label)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.list_(pa.float64())), pa.array(labels, pa.int32())], ["logits", "label"]
            )

    held = (
        chosen.where(F.col("part") == SHARDS)
        .select("text", "label")
        .mapInArrow(score, "logits array<double>, label int")
        .collect()  # a fifth of the sample
    )
    logits = np.array([r["logits"] for r in held]).reshape(len(held), size)
    model.temperature = best_temperature(logits, np.array([r["label"] for r in held], int))
    scorer.unpersist()
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of rows (doc_id, held_out, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())]
    )

    def run(batches):
        m = shared.value
        for batch in batches:
            found = [m.predict(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                schema=kinds,
            )

    rows = bounded_batches(docs.select("doc_id", "held_out", "text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn from what is not held out, predict all."""
    rows = narrow(docs, doc_id="bigint", text="string", lang="string")
    rows = rows.withColumn("held_out", held_out(F.col("doc_id")))
    train = rows.where("not held_out and lang is not null and doc_id is not null")
    return predict(rows, fit(train, sample_rows))
