"""The queries opN_<name> of the operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, decontaminate, html, jaccard, katz, language, manifest, oracles, packing, pii, quality, secrets, suffix,
    variants,
)
from .common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, with a digest of their ids."""
    docs = table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


# Of the pseudonyms; a deployment passes its own secret.
PII_KEY = "rarescan"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced, and how much of each kind."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.replace_personal(docs, PII_KEY)
    number = lambda kind: F.size(F.filter("personal", lambda p: p["kind"] == kind)).cast("long")
    return found.select("doc_id", "text", *(number(kind).alias(f"n_{kind}") for kind in pii.KINDS))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all documents lose to repeated strings of 50 bytes."""
    found = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    length = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda a, s: a + (s["stop"] - s["start"])
    )
    return found.select(
        "doc_id",
        "n_bytes",
        F.coalesce(length, F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(F.size("spans").cast("long"), F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce(F.sha2("kept", 256), "sha256").alias("kept_sha256"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of all documents, cutoffs per language."""
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id", *(F.col("facts")[c].alias(c) for c in counts), "base_failed", "kept"
    )


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of all documents."""
    found = jaccard.join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("size").alias("n_shingles"), "component_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold which benchmark item, by alignment score."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find(docs, benchmark, short=True)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents, learned from three of four."""
    return language.identify(table(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    found = html.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


# Control strings as texts: the conversation -1 that each run has besides the table's.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and what is read back from the formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    formed = chat.format_conversations(rows.unionByName(probe))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    read = formed.select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of all documents, with those that look live by their owners."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(number(kind.name).alias(f"n_{kind.name}") for kind in secrets.BASE),
        F.sha2(secrets.span_list(F.col("base")), 256).alias("base_sha256"),
        secrets.span_list(F.sort_array(F.concat("base", "more"))).alias("spans"),
        F.size(F.filter("base", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("base", lambda s: ~s["live"])).cast("long").alias("n_copied"),
    )


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of all documents, and whether a tampered half still folds to the root."""
    docs = table(spark, sf_dir, "documents")
    fields = {name: F.col(name) for name in FIELDS}
    tampered = fields | {"text": F.translate("text", "\n", "")}
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    rows = docs.select(
        F.col("source").alias("tree"),
        F.col("doc_id").alias("key"),
        manifest.leaf(list(fields.values())).alias("leaf"),
        F.when(even, manifest.leaf(list(tampered.values()))).alias("other"),
    )
    found = manifest.manifest(rows)
    folded = manifest.fold(F.coalesce("other", "leaf"), F.col("path"))
    return found.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        manifest.proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of six sevenths of them."""
    docs = table(spark, sf_dir, "documents")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    found = katz.score(docs.select("doc_id", "text"), rest == 2)
    return found.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their neighbours, forms and roots; every 199th run loses a letter."""
    return variants.group(table(spark, sf_dir, "documents"), edit_every=199)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_jaccard": op2_jaccard,
    "op3_decontamination": op3_decontamination,
    "op4_language": op4_language,
    "op5_pii": op5_pii,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality": op7_quality,
    "op8_html": op8_html,
    "op9_chat": op9_chat,
    "op10_secrets": op10_secrets,
    "op11_manifest": op11_manifest,
    "op12_katz": op12_katz,
    "op13_variants": op13_variants,
}
# Tokens, alignments, fitted models, keyed permutations, suffixes and parser events have no
# SQL; the tests hold those queries against brute force.
ORACLES: dict[str, str] = {
    "op2_jaccard": oracles.JACCARD,
    "op7_quality": oracles.QUALITY,
    "op9_chat": oracles.CHAT,
    "op10_secrets": oracles.SECRETS,
    "op11_manifest": oracles.MANIFEST,
    "op12_katz": oracles.KATZ,
    "op13_variants": oracles.VARIANTS,
}
