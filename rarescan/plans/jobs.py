"""The whole pipeline as callable jobs: prepare, profile, train, evaluate, decide.

Jobs hand over through the store.  A rerun replaces the outputs of a job and
leaves saved models alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rarescan.config import BANK_APPLICATIONS, SETTINGS, Roles, Settings
from rarescan.operators import (
    association,
    curves,
    decisions,
    explain,
    metrics,
    preprocess,
    profile,
    sampling,
)
from rarescan.operators.quantiles import exact_quantiles
from rarescan.plans import training
from rarescan.plans.models import STACK_OPTIONAL, STACK_REQUIRED, STACKING, choose_models
from rarescan.sources.shared import materialize
from rarescan.sources.store import Store, report_section
from rarescan.sources.tables import read_table, with_key, with_label

# Committee member -> trained model.
COMMITTEE = {"lightgbm": "lgbm", "xgboost": "xgb", "mlp": "mlp"}


def prepare(
    spark: SparkSession,
    source: str,
    store: Store,
    fmt: str = "parquet",
    schema=None,
    roles: Roles = BANK_APPLICATIONS,
    settings: Settings = SETTINGS,
    max_rows: int | None = None,
    exact: bool = False,
    narrow: bool = False,
) -> DataFrame:
    """Read, check, split and write the table; returns the split summary."""
    df = with_key(with_label(read_table(spark, source, fmt, schema), roles.label), roles.key)
    salt = str(settings.seed)
    if max_rows:
        df = sampling.sample_rows(df, roles.key, max_rows, f"{salt}-rows")
    if exact:
        df = sampling.with_exact_split(df, roles.key, roles.label, settings.test_fraction, salt)
    else:
        df = sampling.with_split(df, roles.key, settings.test_fraction, salt)
    if narrow:  # types are decided on train and hold for both splits
        train = df.where(F.col("split") == sampling.TRAIN)
        numeric = [c for c in roles.numeric if c in df.columns]
        df = profile.narrow_types(df, profile.type_plan(train, [*numeric, roles.label]))
    store.write_splits(df)
    written = store.read_splits()
    return sampling.split_summary(written, roles.label)


def profile_tables(
    df: DataFrame, roles: Roles = BANK_APPLICATIONS, settings: Settings = SETTINGS
) -> dict[str, DataFrame]:
    """All profile tables of a data set, by name."""
    numeric = [c for c in roles.numeric if c in df.columns]
    categorical = [c for c in roles.categorical if c in df.columns]
    label, key = roles.label, roles.key
    columns = [label, *numeric, *categorical]
    quartiles = exact_quantiles(df, [*numeric, label], profile.QUARTILES)
    features = {c: quartiles[c] for c in numeric}
    tables = {
        "quality": profile.quality_table(df, columns),
        "duplicates": profile.duplicate_rows(df.select(*columns)),
        "describe": profile.describe_numeric(df, [*numeric, label], quartiles),
        "outliers": profile.iqr_outliers(df, numeric, features),
        "domains": profile.category_domain(df, categorical),
        "target": profile.target_distribution(df, label),
        "risk": profile.categorical_risk(df, categorical, label),
        "histograms": profile.histogram(df, numeric),
        "boxes": profile.box_stats(df, numeric, label),
        "classes": profile.class_profile(df, numeric, categorical, label),
        "correlation": association.spearman(df, key, [*numeric, label]),
        "rank_tests": association.mann_whitney(df, numeric, label),
        "mutual_information": association.mi_binned(df, numeric, label),
        "mutual_information_knn": association.mi_knn(
            df, key, numeric, label, f"{settings.seed}-mi"
        ),
    }
    monthly = profile.rate_by_period(df, roles.period, label) if roles.period else None
    if monthly is not None:
        tables["periods"] = monthly
    tables["target_correlation"] = association.target_correlation(tables["correlation"], label)
    return tables


# report table -> column that names its rows
SECTIONS = {
    "quality": "feature",
    "outliers": "feature",
    "describe": "feature",
    "rank_tests": "feature",
    "mutual_information": "feature",
    "target_correlation": "feature",
    "domains": "feature",
}


def write_profile(
    df: DataFrame, store: Store, roles: Roles = BANK_APPLICATIONS, settings: Settings = SETTINGS
) -> list[str]:
    """Write every profile table, the screening and the report in long form."""
    names = []
    for name, table in profile_tables(df, roles, settings).items():
        store.write_report(name, table)
        names.append(name)
    screened = association.screen_features(
        *[
            store.read_report(n)
            for n in ("describe", "outliers", "mutual_information", "rank_tests")
        ]
    )
    store.write_report("screening", screened)
    report = None
    for name, key in SECTIONS.items():
        part = report_section(store.read_report(name), name, key)
        report = part if report is None else report.unionByName(part)
    store.write_report("report", report)
    return [*names, "screening", "report"]


def train_models(
    store: Store,
    names: Sequence[str],
    run_id: str,
    roles: Roles = BANK_APPLICATIONS,
    settings: Settings = SETTINGS,
    undersampling_ratio: float | None = None,
    candidates: Mapping[str, Sequence[Mapping]] | None = None,
) -> list[str]:
    """Train the chosen models, the stack last; returns their names."""
    df = store.read_split(sampling.TRAIN)
    chosen = choose_models(list(names))
    params: dict[str, Mapping] = {}
    for name in [n for n in chosen if n != STACKING]:
        done = training.train(
            df,
            name,
            run_id,
            store,
            roles,
            settings,
            undersampling_ratio,
            (candidates or {}).get(name),
        )
        params[name] = done.params
    if STACKING in chosen:
        wanted = (*STACK_REQUIRED, *STACK_OPTIONAL)
        known = {**{n: p for n in wanted if (p := store.best_params(n)) is not None}, **params}
        bases = {n: known[n] for n in wanted if n in known}
        training.train_stack(df, bases, run_id, store, roles, settings)
    return chosen


def evaluate(
    scored: DataFrame, label: str, threshold: float, score: str = "score"
) -> dict[str, DataFrame]:
    """Every metric table of one scored data set, which is read from one written copy."""
    scored = materialize(scored.select(label, score), "scored")
    points = curves.curve_points(scored, [score], label)
    counts = metrics.confusion_counts(
        scored,
        label,
        {"default": (score, metrics.DEFAULT_THRESHOLD), "tuned": (score, threshold)},
    )
    return {
        "areas": curves.areas(points),
        "roc": curves.roc_curve(points),
        "pr": curves.pr_curve(points),
        "metrics": metrics.binary_metrics(counts),
        "confusion": metrics.confusion_cells(counts),
        "report": metrics.class_report(counts),
        "comparison": metrics.compare_thresholds(scored, label, {score: threshold}),
    }


def evaluate_model(
    store: Store,
    name: str,
    run_id: str,
    evaluated_at: str,
    roles: Roles = BANK_APPLICATIONS,
) -> dict[str, DataFrame]:
    """Score the test split with a saved model, write its tables, log its metrics."""
    model = store.load_model(name, run_id)
    test = store.read_split(sampling.TEST)
    threshold = store.load_threshold(name)
    tables = evaluate(
        training.score(model, test, name, [roles.label]), roles.label, threshold
    )
    if name == STACKING:  # one coefficient per base model
        names = [c.removesuffix("__p") for c in model.stages[-2].getInputCols()]
    else:
        names = preprocess.feature_names(model.transform(test))
    top = explain.importances(store.spark, model.stages[-1], names)
    if top is not None:
        tables["importances"] = top
    for table, frame in tables.items():
        store.write_report(f"{name}/{table}", frame)
    area = store.read_report(f"{name}/areas").first()
    at = {r["name"]: r for r in store.read_report(f"{name}/metrics").collect()}
    pairs = [tuple(at[w][m] for m in ("f1", "precision", "recall")) for w in ("default", "tuned")]
    store.log_evaluation(
        (
            run_id,
            name,
            evaluated_at,
            area["roc_auc"],
            area["pr_auc"],
            threshold,
            *pairs,
            {c: at["tuned"][c] for c in ("tn", "fp", "fn", "tp")},
        )
    )
    return tables


def enforce_precision(
    store: Store,
    name: str,
    run_id: str,
    scored_holdout: DataFrame,
    label: str,
    target: float = curves.PRECISION_TARGET,
) -> float:
    """Replace a model's threshold by the one that reaches the precision target.

    The scored rows must be a hold-out, not the test split; the source is saved.
    """
    points = curves.curve_points(scored_holdout, ["score"], label)
    threshold = curves.require_precision(points, target).first()["threshold"]
    store.save_threshold(name, run_id, threshold, f"precision {target}")
    return threshold


def committee_scores(
    store: Store, df: DataFrame, roles: Roles = BANK_APPLICATIONS
) -> tuple[DataFrame, dict[str, tuple[str, float]]]:
    """Add one score column per saved committee model; a missing model is left out."""
    members: dict[str, tuple[str, float]] = {}
    out = df
    for member, name in COMMITTEE.items():
        if not store.has_model(name):
            continue
        model = store.load_model(name)
        keep = out.columns
        column = f"score_{member}"
        out = training.score(model, out, name, keep).withColumnRenamed("score", column)
        members[member] = (column, store.load_threshold(name))
    if not members:
        raise ValueError("no committee model has been saved")
    return out, members


def decide(
    store: Store,
    df: DataFrame,
    roles: Roles = BANK_APPLICATIONS,
    ticket: float = decisions.TICKET,
) -> tuple[DataFrame, DataFrame]:
    """Committee decision per row, and the cost report over all rows."""
    scored, members = committee_scores(store, df, roles)
    columns = [roles.key, roles.label, *[s for s, _ in members.values()]]
    decided = decisions.with_committee(scored.select(*columns), members, details=True)
    # written once: scoring runs the models, and both results read it
    decided = materialize(decided, "decided")
    return decided, decisions.cost_report(decided, roles.label, ticket=ticket)
