"""From scores to decisions: three tiers, committee votes, outcomes and costs.

All rules are column expressions over one row, so a batch table and a stream
take the same path and the table never moves.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarescan.functions.columns import ratio0

# Decision names and rule constants.
BLOCK, REVIEW, APPROVE = "block", "review", "approve"
ERROR = "error"
REVIEW_SHARE = 0.8
VETO_MODEL = "mlp"
TICKET = 3500.0
CONFIDENCE = {
    "unanimous": "high: unanimous",
    "majority": "medium: majority",
    "veto": "medium: single veto",
    "accepted": "medium: minor disagreement, risk accepted",
    "clear": "high: clear",
    "error": "no active model",
}


def three_tier(score: str | Column, threshold: float) -> Column:
    """Block strictly above the threshold, review strictly above 80 % of it.

    A row without a score is an error, as it is for a committee without members.
    """
    score = F.col(score) if isinstance(score, str) else score
    return (
        F.when(score.isNull(), ERROR)
        .when(score > F.lit(threshold), BLOCK)
        .when(score > F.lit(threshold * REVIEW_SHARE), REVIEW)
        .otherwise(APPROVE)
    )


def agreement(score: str | Column, threshold: float, label: str) -> Column:
    """1 when ``score > threshold`` says the same as the label."""
    score = F.col(score) if isinstance(score, str) else score
    return ((score > F.lit(threshold)).cast("int") == F.col(label)).cast("int")


def _votes(members: Mapping[str, tuple[str, float]]) -> dict[str, Column]:
    return {
        m: F.coalesce(F.col(score) >= F.lit(float(t)), F.lit(False)).cast("int")
        for m, (score, t) in members.items()
    }


def with_committee(
    df: DataFrame,
    members: Mapping[str, tuple[str, float]],
    veto: str = VETO_MODEL,
    details: bool = False,
) -> DataFrame:
    """Committee decision per row.

    ``members`` maps a model to (score column, threshold).  A model without a
    score column, or with a null score, is not active and shrinks the committee.
    """
    members = {m: st for m, st in members.items() if st[0] in df.columns}
    if not members:
        raise ValueError("no committee member has a score column")
    votes = _votes(members)
    out = df.withColumns(
        {
            "fraud_votes": sum(votes.values(), F.lit(0)),
            "active_models": sum(
                (F.col(s).isNotNull().cast("int") for s, _ in members.values()), F.lit(0)
            ),
        }
    )
    cast, active = F.col("fraud_votes"), F.col("active_models")
    majority = F.floor(active / 2) + 1
    blocked = cast >= majority
    vetoed = (cast == 1) & (votes[veto] == 1) if veto in votes else F.lit(False)

    def rule(error, unanimous, most, single, minor, none) -> Column:
        return (
            F.when(active == 0, error)
            .when(blocked & (cast == active), unanimous)
            .when(blocked, most)
            .when(vetoed, single)
            .when(cast > 0, minor)
            .otherwise(none)
        )

    out = out.withColumns(
        {
            "decision": rule(ERROR, BLOCK, BLOCK, REVIEW, APPROVE, APPROVE),
            "confidence": rule(
                *[
                    CONFIDENCE[k]
                    for k in ("error", "unanimous", "majority", "veto", "accepted", "clear")
                ]
            ),
        }
    )
    return out.withColumn("committee", committee_details(members)) if details else out


def committee_details(members: Mapping[str, tuple[str, float]]) -> Column:
    """{model: (score, threshold, vote)} of the active members, 4 decimals."""
    votes = _votes(members)
    entries = [
        F.when(
            F.col(s).isNotNull(),
            F.struct(
                F.lit(m).alias("key"),
                F.struct(
                    F.round(F.col(s), 4).alias("score"),
                    F.round(F.lit(float(t)), 4).alias("threshold"),
                    votes[m].alias("vote_fraud"),
                ).alias("value"),
            ),
        )
        for m, (s, t) in members.items()
    ]
    return F.map_from_entries(F.array_compact(F.array(*entries)))


def vote_rows(df: DataFrame, key: str, members: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row per application and active member."""
    votes = _votes(members)
    entries = [
        F.struct(
            F.lit(m).alias("model"),
            F.col(s).alias("score"),
            F.lit(float(t)).alias("threshold"),
            votes[m].alias("vote"),
        )
        for m, (s, t) in members.items()
        if s in df.columns
    ]
    return (
        df.select(key, F.explode(F.array(*entries)).alias("e"))
        .select(key, "e.*")
        .where("score IS NOT NULL")
    )


def outcome(label: str, decision: str = "decision") -> Column:
    """TP, FP, RM, TN or FN; null for a row no model could judge."""
    positive, decided = F.col(label) == 1, F.col(decision)
    return (
        F.when(decided == BLOCK, F.when(positive, "TP").otherwise("FP"))
        .when(decided == REVIEW, "RM")
        .when(decided == APPROVE, F.when(positive, "FN").otherwise("TN"))
    )


def outcome_counts(df: DataFrame, label: str, decision: str = "decision") -> DataFrame:
    return df.groupBy(outcome(label, decision).alias("outcome")).agg(F.count("*").alias("n"))


def cost_report(
    df: DataFrame, label: str, decision: str = "decision", ticket: float = TICKET
) -> DataFrame:
    """One row of totals: outcomes, hit rate, friction and money.

    Negatives are counted in the data itself.
    """
    kind = outcome(label, decision)
    names = ("TP", "TN", "FN", "FP", "RM")
    totals = df.agg(
        F.count("*").alias("total"),
        F.count(F.when(F.col(label) == 0, 1)).alias("n_legit"),
        F.count(F.when(F.col(label) == 1, 1)).alias("n_fraud"),
        *[F.count(F.when(kind == k, 1)).alias(k.lower()) for k in names],
    )
    return totals.select(
        *totals.columns,
        (ratio0(F.col("tp") + F.col("tn"), F.col("total") - F.col("rm")) * 100).alias(
            "hit_rate_pct"
        ),
        (ratio0(F.col("fp"), F.col("n_legit")) * 100).alias("friction_pct"),
        (F.col("tp") * ticket).alias("saved"),
        (F.col("fn") * ticket).alias("lost"),
        (F.col("n_legit") * ticket).alias("legit_revenue"),
    )
