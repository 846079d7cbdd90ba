"""Quality rules with risk-controlled thresholds.

A few share-of-junk measures are taken from every whole text, each with fixed
cutoffs from loose to strict; a level rejects what exceeds any of its cutoffs, so
what a level rejects grows with it.  For each stratum, the levels are tested in that order
on the labelled good documents: a level passes while the exact binomial tail
``P(X <= rejected | n, risk)`` is within the significance, i.e. while it is
proven that at most the share ``risk`` of the good documents is lost.  Testing
stops at the first failure (a fixed sequence, so further levels cost nothing);
over the strata the significance is divided (Bonferroni).  With confidence
``1 - level`` no stratum loses more than ``risk`` of its good documents.  A
stratum without enough labels rejects nothing beyond the base rule.

Defined cases: a null or empty text has no words and fails the base rule; a
null stratum is a stratum of its own; repeated documents are judged alike;
repeated labels of a document count once, as good if all say so; null labels are
none; without labels only the base rule holds; an empty table gives no rows;
further columns of documents stay as they are in ``filter_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import discard, materialize
from .common import let, narrow, words_of

RISK = 0.02  # share of the good documents that a stratum may lose
LEVEL = 0.05  # chance that any stratum loses more
SYMBOLS = "#*$%&|<>"
STRESS = "!?"
WINDOW = 5
TAIL_TERMS = 200
BROADCAST_STRATA = 10_000

# Cutoffs by level, loosest first; a level rejects values above any of its cutoffs.
CUTOFFS: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (2.0, 1.0, 0.4, 0.3, 0.2, 0.1),
    "repeated_share": (0.18, 0.15, 0.12, 0.1, 0.08, 0.05),
    "duplicate_line_share": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2),
    "upper_share": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2),
    "stress_per_word": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2),
}
LEVELS = 6


def _repeat_words(windows: Column) -> Column:
    """Words covered by a window whose hash occurs twice or more.

    Windows of one text are sorted as (hash, place); those equal to a neighbour
    give the sorted places, and each place covers WINDOW words up to the next.
    """
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(rows: Column) -> Column:
        return F.filter(
            rows,
            lambda row, k: ((k > 0) & (F.get(rows, k - 1)["h"] == row["h"]))
            | F.coalesce(F.get(rows, k + 1)["h"] == row["h"], F.lit(False)),
        )

    def covered(places: Column) -> Column:
        steps = F.transform(
            places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, s: a + s)

    return let(
        pairs,
        lambda rows: let(
            F.sort_array(F.transform(repeated(rows), lambda row: row["i"])), covered
        ),
    )


def _window_hashes(words: Column) -> Column:
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, WINDOW))),
    )


def _repeats(words: Column) -> Column:
    return let(
        _window_hashes(words),
        lambda hashes: F.when(
            F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")
        ).otherwise(_repeat_words(hashes)),
    )


def _duplicate_lines(text: Column) -> Column:
    def counts(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.struct(F.size(x).cast("long").alias("lines"), counts(x).cast("long").alias("dup")))


def _word_facts(words: Column) -> Column:
    return let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeats(w).alias("n_repeat_words"),
        ),
    )


def _count_of(text: Column, characters: str) -> Column:
    rest = F.translate(text, characters, "")
    return (F.char_length(text) - F.char_length(rest)).cast("long")


def facts_of(text: Column) -> Column:
    """A struct of base counts and shares of a whole text."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    facts = F.struct(
        _word_facts(words_of(whole)).alias("w"),
        _count_of(whole, SYMBOLS).alias("n_symbols"),
        _duplicate_lines(whole).alias("l"),
        F.char_length(F.regexp_replace(whole, r"[^\p{Lu}]+", "")).alias("upper"),
        _count_of(whole, STRESS).alias("stress"),
    )

    def shares(f: Column) -> Column:
        words = F.greatest(f["w"]["n_words"], F.lit(1))
        return F.struct(
            f["w"]["n_words"].alias("n_words"),
            f["w"]["word_chars"].alias("word_chars"),
            f["n_symbols"].alias("n_symbols"),
            f["l"]["dup"].alias("n_dup_lines"),
            f["w"]["n_repeat_words"].alias("n_repeat_words"),
            (f["n_symbols"] / words).alias("symbols_per_word"),
            (f["w"]["n_repeat_words"] / words).alias("repeated_share"),
            (f["l"]["dup"] / F.greatest(f["l"]["lines"], F.lit(1))).alias("duplicate_line_share"),
            (f["upper"] / F.greatest(f["w"]["word_chars"], F.lit(1))).alias("upper_share"),
            (f["stress"] / words).alias("stress_per_word"),
        )

    return let(facts, shares)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with a struct column ``facts`` of base counts and shares."""
    return docs.withColumn("facts", facts_of(F.col(f"`{text}`")))


def base_failed(facts: Column) -> Column:
    return (facts["n_words"] < 10) | (100 * facts["n_repeat_words"] > 20 * facts["n_words"])


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x), x >= 1: Stirling's series at x + 8, then the recurrence back."""
    y = x + 8
    series = (
        (y - 0.5) * F.log(y) - y + 0.9189385332046727
        + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, 5))
    )
    steps = F.lit(0.0)
    for k in range(8):
        steps = steps + F.log(x + k)
    return series - steps


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), for k at most n * p (else 1).

    The terms fall from k downwards; they are summed until TAIL_TERMS, and the
    rest is replaced by the geometric series above it, so the result is exact
    up to rounding for small k and never too small.
    """
    first = F.exp(
        _log_gamma(n + 1.0) - _log_gamma(k + 1.0) - _log_gamma(n - k + 1.0)
        + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    )
    odds = (1 - p) / p
    state = F.struct(first.alias("term"), first.alias("sum"))

    def step(a: Column, j: Column) -> Column:
        i = k - j  # the term of i + 1 gives that of i
        term = F.when(i >= 0, a["term"] * (i + 1) / (n - i) * odds).otherwise(F.lit(0.0))
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    ratio = k / (n - k + 1) * odds

    def with_rest(a: Column) -> Column:
        rest = F.when(a["term"] > 0, a["term"] * ratio / (1 - ratio)).otherwise(0.0)
        return F.least(F.lit(1.0), a["sum"] + rest)

    total = F.aggregate(F.sequence(F.lit(1), F.lit(TAIL_TERMS)), state, step, with_rest)
    return F.when(k < n * p, total).otherwise(F.lit(1.0))


def _rejected(facts: Column, level: int) -> Column:
    above = F.lit(False)
    for name, cuts in CUTOFFS.items():
        above = above | (facts[name] > cuts[level])
    return above


def thresholds(
    facts: DataFrame, labels: DataFrame, stratum: str, risk: float = RISK, level: float = LEVEL
) -> DataFrame:
    """Rows (stratum, n good documents, n_rejected by level, passed): ``passed`` levels are proven.

    ``facts`` has doc_id, ``stratum`` and the struct ``facts``.
    """
    good = (
        narrow(labels, doc_id="bigint", quality="int")
        .where("quality is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
        .select("doc_id")
    )
    held = facts.where(~base_failed(F.col("facts"))).join(good, "doc_id", "left_semi")
    counts = held.groupBy(F.col(stratum).alias("stratum")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.array(
            *(F.count_if(_rejected(F.col("facts"), i)).cast("double") for i in range(LEVELS))
        ).alias("n_rejected"),
    )
    strata = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    passes = F.transform(
        "n_rejected", lambda k: binomial_tail(k, F.col("n"), risk) <= level / F.col("strata")
    )
    failed = F.array_position(passes, False)
    passed = F.when(failed == 0, LEVELS).otherwise(failed - 1).cast("int")
    return counts.withColumn("strata", strata).withColumn("passed", passed).drop("strata")


def _with_levels(rows: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """The rows with the number of proven levels of their stratum as ``_passed``.

    ``cutoffs`` has a row per stratum; it is counted, and sent to all tasks
    while it is small, since a stratum may hold most of the rows.
    """
    limits = cutoffs.select(F.col("stratum").alias("_stratum"), F.col("passed").alias("_passed"))
    if limits.count() <= BROADCAST_STRATA:
        limits = F.broadcast(limits)
    joined = rows.join(limits, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    return joined.drop("_stratum")


def is_kept(facts: Column, passed: Column) -> Column:
    """Neither the base rule nor the strictest proven level rejects the text."""
    above = F.lit(False)
    for i in range(LEVELS):
        above = above | ((passed == i + 1) & _rejected(facts, i))
    return ~base_failed(facts) & ~F.coalesce(above, F.lit(False))


def verdicts(facts: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """``facts`` with base_failed and kept."""
    joined = _with_levels(facts, cutoffs, stratum)
    return (
        joined.withColumn("base_failed", base_failed(F.col("facts")))
        .withColumn("kept", is_kept(F.col("facts"), F.col("_passed")))
        .drop("_passed")
    )


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, facts, base_failed and kept of every document; texts are read once."""
    facts = measures(narrow(docs, doc_id="bigint", text="string", **{stratum: "string"}))
    facts = materialize(facts.drop("text"), "quality")
    cutoffs = materialize(thresholds(facts, labels, stratum), "cutoffs")
    return verdicts(facts, cutoffs, stratum)


def filter_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The kept documents with the columns they came with.

    The cutoffs come from a first pass that keeps counts only; the second pass
    takes the measures of each row again and filters it, so no text is shuffled.
    """
    facts = measures(narrow(docs, doc_id="bigint", text="string", **{stratum: "string"}))
    facts = materialize(facts.drop("text"), "quality")
    cutoffs = materialize(thresholds(facts, labels, stratum), "cutoffs")
    discard(facts)
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col("text").cast("string").alias("text"),
        F.col(f"`{stratum}`").cast("string").alias("group"),
    )
    # one expression: the measures of a row are taken once, wherever the filter goes
    keep = let(facts_of(F.col("text")), lambda f: is_kept(f, F.col("_passed")))
    kept = _with_levels(rows, cutoffs, "group").where(keep)
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
