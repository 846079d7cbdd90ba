"""Secret scans with the ownership of each value over the whole corpus.

Patterns find candidates in every whole text.  The hashes of their values are
counted over the corpus by distinct repositories and owners: a value of many owners
is a copied example, one of few owners looks live.  Base kinds are always reported;
further kinds, less certain by themselves, add their spans only if they look live
and do not overlap a base span.

Only hashes and places leave the first pass.  They are written once; the verdicts
come from counts that are combined before each shuffle, and join back by
a digest of a text's candidates, so copies of a text are one row of the join.

Defined cases: a null or empty text has no spans; a null owner or repository counts
as one of its own; repeated rows are judged alike and count once; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialize
from .common import let, narrow

WIDE_OWNERS = 5  # owners from which on a value is a copied example


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    least: int  # characters of the value
    group: int = 0  # of the pattern that holds the value
    holds: tuple[str, ...] = ()  # some of which a text must contain, in lower case
    also: tuple[str, ...] = ()  # patterns that a value must match


# Fixed by the contract of the query.
BASE = (
    Kind(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        2,
        ("passw", "secret", "token", "apikey", "api_key"),
    ),
    Kind("access", r"AKIA[A-Z0-9]+", 20, holds=("akia",)),
    Kind("hex", r"[0-9a-f]{24,}", 24),
)
MORE = (
    Kind("bearer", r"[Bb]earer\x20+[A-Za-z0-9._~+/=-]{20,}", 27, holds=("earer",)),
    Kind("vendor", r"\b(?:gh[opsu]_|sk_live_|xox[abp]-)[A-Za-z0-9_-]{16,}", 20, holds=("gh", "sk_live_", "xox")),
    Kind("opaque", r"[A-Za-z0-9+/_-]{32,}={0,2}", 32, also=("[A-Z]", "[a-z]", "[0-9]")),
)
SPAN = "struct<start:bigint,rank:int,stop:bigint,kind:string,hash:string>"


def _located(text: Column, kind: Kind, rank: int) -> Column:
    """Spans of the matches, left to right: each starts where the pieces before it end."""
    pieces = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), 0)
    nothing = F.array().cast(f"array<{SPAN}>")

    def step(a: Column, m: Column) -> Column:
        start = a["at"] + m["gap"]
        stop = start + F.char_length(m["text"])
        value = F.regexp_extract(m["text"], kind.pattern, kind.group) if kind.group else m["text"]
        keep = F.char_length(value) >= kind.least
        for pattern in kind.also:
            keep = keep & value.rlike(pattern)
        span = F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            stop.alias("stop"),
            F.lit(kind.name).alias("kind"),
            F.sha2(value, 256).alias("hash"),
        )
        found = F.when(keep, F.concat(a["found"], F.array(span))).otherwise(a["found"])
        return F.struct(stop.alias("at"), found.cast(f"array<{SPAN}>").alias("found"))

    def walk(gaps: Column) -> Column:
        zero = F.struct(F.lit(0).cast("bigint").alias("at"), nothing.alias("found"))
        rows = F.transform(
            matches,
            lambda m, i: F.struct(
                F.char_length(F.get(gaps, i)).cast("bigint").alias("gap"), m.alias("text")
            ),
        )
        return F.aggregate(rows, zero, step, lambda a: a["found"])

    return F.when(text.rlike(kind.pattern), let(pieces, walk)).otherwise(nothing)


def candidates(text: Column) -> Column:
    """All candidate spans of a text, by kind and place."""
    def by_kind(low: Column) -> Column:
        found = []
        for rank, kind in enumerate(BASE + MORE):
            spans = _located(text, kind, rank)
            if kind.holds:
                some = F.lit(False)
                for part in kind.holds:
                    some = some | F.contains(low, F.lit(part))
                spans = F.when(some, spans).otherwise(F.array().cast(f"array<{SPAN}>"))
            found.append(spans)
        return F.concat(*found)

    return let(F.lower(text), by_kind)


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories) of rows (hash, owner, repository)."""
    return (
        found.groupBy("hash", "owner", "repository")
        .agg(F.lit(1).alias("one"))
        .groupBy("hash", "owner")
        .agg(F.count("one").alias("repositories"))
        .groupBy("hash")
        .agg(
            F.count(F.lit(1)).alias("n_owners"),
            F.sum("repositories").alias("n_repositories"),
        )
    )


def scan(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    wide_owners: int = WIDE_OWNERS,
) -> DataFrame:
    """(doc_id, base, more): sorted spans, each with n_owners, n_repositories and live."""
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col(f"`{owner}`").cast("string").alias("owner"),
        F.col(f"`{repository}`").cast("string").alias("repository"),
    )
    found = source.select("doc_id", "owner", "repository", candidates(F.col("text")).alias("spans"))
    found = found.withColumn("digest", F.when(F.size("spans") > 0, F.sha2(F.to_json("spans"), 256)))
    found = materialize(found, "secrets")
    hits = found.where("digest is not null")
    values = hits.select("owner", "repository", F.explode(F.array_distinct("spans.hash")).alias("hash"))
    each = hits.groupBy("digest").agg(F.first("spans").alias("spans"))
    each = each.select("digest", F.explode("spans").alias("span")).select("digest", "span.*")
    judged = each.join(ownership(values), "hash").select(
        "digest",
        F.struct(
            "start", "rank", "stop", "kind", "hash", "n_owners", "n_repositories",
            (F.col("n_owners") < wide_owners).alias("live"),
        ).alias("span"),
    )
    listed = judged.groupBy("digest").agg(F.sort_array(F.collect_list("span")).alias("spans"))

    def base(span: Column) -> Column:
        return span["rank"] < len(BASE)

    base_spans = F.filter("spans", base)
    more_spans = F.filter(
        "spans",
        lambda s: ~base(s)
        & s["live"]
        & ~F.exists(
            "spans", lambda b: base(b) & (b["start"] < s["stop"]) & (s["start"] < b["stop"])
        ),
    )
    listed = listed.select("digest", base_spans.alias("base"), more_spans.alias("more"))
    kinds = {name: kind.dataType.simpleString() for name, kind in zip(listed.columns, listed.schema, strict=True)}
    clean = found.where("digest is null").select(
        "doc_id", *(F.array().cast(kinds[c]).alias(c) for c in ("base", "more"))
    )
    return hits.select("doc_id", "digest").join(listed, "digest").drop("digest").unionByName(clean)


def span_list(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )
