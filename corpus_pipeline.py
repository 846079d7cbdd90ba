"""The corpus pipeline: five operators in a row over the documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
to the shared folder and reads it again as the next stage's documents, so a lost
executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rarescan.llm import decontaminate, jaccard, packing, pii, quality
from rarescan.llm.common import table, unused
from rarescan.llm.queries import PII_KEY
from rarescan.sources.shared import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a proven cutoff of their language rejects."""
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 80 % of their runs of five words in common."""
    return jaccard.keep_one(docs, words=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"), short=True)


def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms; n_chars follows the text."""
    found = unused(docs, "personal")
    replaced = pii.replace_personal(docs, PII_KEY, found=found).drop(found)
    kind = dict(docs.dtypes).get("n_chars")
    if kind is None:
        return replaced
    return replaced.withColumn("n_chars", F.char_length("text").cast(kind))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048, one row per piece with its ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_quality),
    ("n-gram Jaccard join", keep_distinct),
    ("benchmark decontamination", drop_benchmark),
    ("PII", hide_personal),
    ("packing", pack_sequences),
]

# Alignment, keyed permutations and tokens have no SQL; tests hold the stages against
# brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialize(docs, f"stage{number}")
    return docs
