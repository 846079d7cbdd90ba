"""Named queries over the driver tables, one per operator family."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarescan.config import BANK_APPLICATIONS as ROLES
from rarescan.config import SETTINGS
from rarescan.operators import (
    association,
    boosting,
    curves,
    decisions,
    explain,
    features,
    logistic,
    metrics,
    perceptron,
    preprocess,
    profile,
    sampling,
)
from rarescan.operators.quantiles import exact_quantiles
from rarescan.plans import models, training
from rarescan.sources.applications import SCORES, applications, prepared_path, table
from rarescan.sources.shared import materialize, new_path
from rarescan.sources.store import (
    Store,
    latest_evaluation,
    leaderboard,
    report_section,
    thresholds_for,
)
from rarescan.sources.tables import RAW_COLUMNS, raw_schema, read_table, with_label
from rarescan.streaming import decisions as streams

KEY, LABEL = ROLES.key, ROLES.label
NUMERIC, CATEGORICAL = list(ROLES.numeric), list(ROLES.categorical)
SALT = str(SETTINGS.seed)
FOLDS = 3

# Thresholds of the three score columns.
THRESHOLDS = {"score_lightgbm": 0.60, "score_xgboost": 0.55, "score_mlp": 0.55}
MEMBERS = {s.removeprefix("score_"): (s, t) for s, t in THRESHOLDS.items()}
TIER_THRESHOLD = 0.60
MIX = {0: 5_000, 1: 300}
PER_CLASS = 500
SEGMENT_ROWS = 24
SAMPLE_ROWS = 10_000
UNDERSAMPLING_RATIO = 0.5

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


DIGITS = 6


def rounded(df: DataFrame) -> DataFrame:
    """Round real columns, so that two engines can be compared digit by digit."""
    real = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, DIGITS) for c in real}) if real else df


def query(fn):
    """Register ``fn`` under its name; its result is rounded."""

    @wraps(fn)
    def run(spark, sf):
        return rounded(fn(spark, sf))

    QUERIES[fn.__name__] = run
    return run


def _key_summary(df: DataFrame, *by: str) -> DataFrame:
    """Row and positive counts plus the sum of keys: pins down which rows are there."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col(LABEL).cast("bigint")).alias("n_pos"),
        F.sum(KEY).alias("key_sum"),
    )


# ---- preparation ------------------------------------------------------------------


@query
def split_counts(spark, sf):
    return sampling.split_summary(applications(spark, sf), LABEL)


@query
def train_rows(spark, sf):
    return _key_summary(applications(spark, sf, "train"), "split")


@query
def exact_split(spark, sf):
    df = applications(spark, sf).select(KEY, LABEL)
    split = sampling.with_exact_split(df, KEY, LABEL, SETTINGS.test_fraction, SALT)
    return _key_summary(split, "split", LABEL)


@query
def kfold_counts(spark, sf):
    df = applications(spark, sf, "train").select(KEY, LABEL)
    return _key_summary(sampling.with_folds(df, KEY, FOLDS, "fold"), "fold")


@query
def exact_folds(spark, sf):
    df = applications(spark, sf, "train").select(KEY, LABEL)
    return _key_summary(sampling.with_exact_folds(df, KEY, LABEL, FOLDS, "fold"), "fold", LABEL)


@query
def holdout_counts(spark, sf):
    df = applications(spark, sf, "train").select(KEY, LABEL)
    return _key_summary(
        sampling.with_split(df, KEY, SETTINGS.holdout_fraction, "holdout", "part"), "part"
    )


@query
def undersample_counts(spark, sf):
    df = applications(spark, sf, "train").select(KEY, LABEL)
    return _key_summary(sampling.undersample(df, KEY, LABEL, UNDERSAMPLING_RATIO, "under"), LABEL)


@query
def random_sample(spark, sf):
    df = applications(spark, sf).select(KEY, LABEL)
    return sampling.sample_rows(df, KEY, SAMPLE_ROWS, "sample")


@query
def stratified_subsample(spark, sf):
    df = applications(spark, sf).select(KEY, LABEL)
    return _key_summary(
        sampling.stratified_subsample(df, KEY, LABEL, SAMPLE_ROWS, "search"), LABEL
    )


@query
def quota_sample(spark, sf):
    df = applications(spark, sf).select(KEY, LABEL, "score_lightgbm")
    return sampling.class_quota_sample(df, KEY, LABEL, MIX, "mix")


@query
def demo_sample(spark, sf):
    df = applications(spark, sf, "test").select(KEY, LABEL, "score_lightgbm")
    positives = sampling.class_counts(df, LABEL).get(1, 0)
    quotas = sampling.demo_quotas(5, positives)
    picked = sampling.class_quota_sample(df, KEY, LABEL, quotas, "demo")
    return sampling.shuffled(picked, KEY, "demo-order").select(
        KEY,
        LABEL,
        F.col("score_lightgbm").alias("score"),
        decisions.three_tier("score_lightgbm", TIER_THRESHOLD).alias("decision"),
        decisions.agreement("score_lightgbm", TIER_THRESHOLD, LABEL).alias("agrees"),
    )


@query
def class_weights(spark, sf):
    df = applications(spark, sf, "train").select(KEY, LABEL)
    weights = sampling.balanced_weights(sampling.class_counts(df, LABEL))
    weighted = sampling.with_weights(df, LABEL, weights, "balanced")
    weighted = sampling.with_weights(weighted, LABEL, sampling.positive_weight(90), "fixed")
    return weighted.groupBy(LABEL).agg(
        F.count("*").alias("n"),
        F.max("balanced").alias("balanced_weight"),
        F.max("fixed").alias("fixed_weight"),
        F.sum("balanced").alias("total_weight"),
    )


@query
def replicated_minority(spark, sf):
    df = applications(spark, sf, "train").select(KEY, LABEL)
    return _key_summary(sampling.replicate_minority(df, KEY, LABEL, "copies"), LABEL)


@query
def type_narrowing(spark, sf):
    plan = profile.type_plan(applications(spark, sf, "train"), [*NUMERIC, LABEL])
    return plan


# ---- profile ---------------------------------------------------------------------


@query
def null_cardinality(spark, sf):
    df = applications(spark, sf)
    marked = df.withColumns(
        {c: F.nullif(F.col(c), F.lit(ROLES.marker_value)) for c in ROLES.marker_flags}
    )
    quality = profile.quality_table(marked, [LABEL, *NUMERIC, *CATEGORICAL])
    return quality.select("feature", "non_null", "null_count", "null_pct", "n_distinct")


@query
def duplicates(spark, sf):
    return profile.duplicate_rows(table(spark, sf, "lineitem"))


@query
def describe_numeric(spark, sf):
    return profile.describe_numeric(applications(spark, sf), [*NUMERIC, LABEL])


@query
def describe_bracketed(spark, sf):
    """As ``describe_numeric``, with quartiles by narrowing brackets."""
    df, columns = applications(spark, sf), [*NUMERIC, LABEL]
    quartiles = exact_quantiles(df, columns, profile.QUARTILES, small_cells=1_000, small=500)
    return profile.describe_numeric(df, columns, quartiles)


@query
def describe_lineitem(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    return profile.describe_numeric(table(spark, sf, "lineitem"), columns)


@query
def iqr_outliers(spark, sf):
    return profile.iqr_outliers(applications(spark, sf), NUMERIC)


@query
def category_domain(spark, sf):
    orders = table(spark, sf, "orders")
    few = profile.category_domain(applications(spark, sf), CATEGORICAL)
    many = profile.category_domain(
        orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day")), ["order_day"]
    )
    return few.unionByName(many)


@query
def target_distribution(spark, sf):
    return profile.target_distribution(applications(spark, sf), LABEL)


@query
def class_filter(spark, sf):
    df = applications(spark, sf).select(KEY, LABEL, "month")
    return _key_summary(df.where(F.col(LABEL) == 1), "month")


@query
def monthly_rate(spark, sf):
    return profile.rate_by_period(applications(spark, sf), ROLES.period, LABEL)


@query
def categorical_risk(spark, sf):
    return profile.categorical_risk(applications(spark, sf), CATEGORICAL, LABEL)


@query
def document_risk(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    labelled = docs.join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")
    return profile.categorical_risk(labelled, ["lang", "source"], "toxic")


@query
def histogram30(spark, sf):
    return profile.histogram(applications(spark, sf), NUMERIC)


@query
def box_stats(spark, sf):
    return profile.box_stats(applications(spark, sf), NUMERIC, LABEL)


@query
def class_profile(spark, sf):
    return profile.class_profile(applications(spark, sf), NUMERIC, CATEGORICAL, LABEL)


# ---- association -----------------------------------------------------------------


@query
def spearman(spark, sf):
    return association.spearman(applications(spark, sf), KEY, [*NUMERIC, LABEL])


# Columns with gaps where the marker for "unknown" stands, and some without.
GAPPY = ["prev_address_months_count", "bank_months_count", "income", "credit_risk_score", LABEL]


@query
def spearman_nulls(spark, sf):
    """Pair by pair over the rows that have both values."""
    df = applications(spark, sf).select(KEY, *GAPPY)
    gaps = {c: F.nullif(F.col(c), F.lit(ROLES.marker_value)) for c in GAPPY[:2]}
    return association.spearman(df.withColumns(gaps), KEY, GAPPY)


@query
def spearman_joined(spark, sf):
    """As ``spearman``, with ranks from joins and running counts over many buckets."""
    columns = [*NUMERIC, LABEL]
    return association.spearman(
        applications(spark, sf), KEY, columns, lookup_values=1_000, rows_per_bucket=2_000
    )


@query
def mann_whitney_buckets(spark, sf):
    """As ``mann_whitney_u``, with running counts over many buckets."""
    return association.mann_whitney(applications(spark, sf), NUMERIC, LABEL, rows_per_bucket=1_000)


@query
def target_correlation(spark, sf):
    matrix = association.spearman(applications(spark, sf), KEY, [*NUMERIC, LABEL])
    return association.target_correlation(matrix, LABEL)


@query
def mann_whitney_u(spark, sf):
    tests = association.mann_whitney(applications(spark, sf), NUMERIC, LABEL)
    return tests


@query
def mann_whitney_segments(spark, sf):
    """Tests per segment of a few rows: exact p-values where nothing is tied."""
    rows = applications(spark, sf).withColumn("segment", F.floor(F.col(KEY) / SEGMENT_ROWS))
    return association.mann_whitney(rows, NUMERIC, LABEL, by=["segment"])


@query
def mann_whitney_sampled(spark, sf):
    df = association.mann_whitney_sample(applications(spark, sf), KEY, LABEL, "ranktest", PER_CLASS)
    tests = association.mann_whitney(df, NUMERIC, LABEL)
    return tests.select("feature", "n1", "n2", "u_stat", "z")


@query
def mi_binned(spark, sf):
    return association.mi_binned(applications(spark, sf), NUMERIC, LABEL)


@query
def mi_knn(spark, sf):
    scores = association.mi_knn(applications(spark, sf), KEY, NUMERIC, LABEL, "mi")
    return scores


@query
def screen_features(spark, sf):
    df = applications(spark, sf)
    quartiles = exact_quantiles(df, NUMERIC, profile.QUARTILES)
    return association.screen_features(
        profile.describe_numeric(df, NUMERIC, quartiles),
        profile.iqr_outliers(df, NUMERIC, quartiles),
        association.mi_binned(df, NUMERIC, LABEL),
        association.mann_whitney(df, NUMERIC, LABEL),
    )


# ---- curves, metrics, thresholds --------------------------------------------------


def _points(spark, sf, by=()):
    columns = [*SCORES, LABEL, *by]
    return curves.curve_points(applications(spark, sf).select(*columns), SCORES, LABEL, by=by)


@query
def roc_curve(spark, sf):
    return curves.roc_curve(_points(spark, sf))


@query
def pr_curve(spark, sf):
    return curves.pr_curve(_points(spark, sf))


@query
def threshold_tradeoff(spark, sf):
    return curves.tradeoff(_points(spark, sf))


@query
def roc_auc(spark, sf):
    return curves.areas(_points(spark, sf)).select("model", "n_pos", "n_neg", "roc_auc")


@query
def average_precision(spark, sf):
    return curves.areas(_points(spark, sf)).select("model", "pr_auc", "prevalence")


@query
def best_fbeta(spark, sf):
    best = None
    points = materialize(_points(spark, sf), "points")
    for beta in (1.0, 2.0):
        one = curves.best_fbeta(points, beta).withColumn("beta", F.lit(beta))
        best = one if best is None else best.unionByName(one)
    return best


@query
def precision_target(spark, sf):
    chosen = None
    points = materialize(_points(spark, sf), "points")
    for target in (0.20, 0.95, 0.999):
        one = curves.precision_target(points, target).withColumn("target", F.lit(target))
        chosen = one if chosen is None else chosen.unionByName(one)
    return chosen


def _cuts() -> dict:
    return {
        **{f"{s}|default": (s, metrics.DEFAULT_THRESHOLD) for s in SCORES},
        **{f"{s}|tuned": (s, t) for s, t in THRESHOLDS.items()},
    }


@query
def confusion(spark, sf):
    return metrics.confusion_cells(metrics.confusion_counts(applications(spark, sf), LABEL, _cuts()))


@query
def binary_metrics(spark, sf):
    return metrics.binary_metrics(metrics.confusion_counts(applications(spark, sf), LABEL, _cuts()))


@query
def class_report(spark, sf):
    return metrics.class_report(metrics.confusion_counts(applications(spark, sf), LABEL, _cuts()))


@query
def compare_thresholds(spark, sf):
    return metrics.compare_thresholds(applications(spark, sf), LABEL, THRESHOLDS)


# ---- decisions --------------------------------------------------------------------


@query
def three_tier(spark, sf):
    df = applications(spark, sf)
    return df.groupBy(
        decisions.three_tier("score_lightgbm", TIER_THRESHOLD).alias("decision"),
        decisions.agreement("score_lightgbm", TIER_THRESHOLD, LABEL).alias("agrees"),
    ).agg(F.count("*").alias("n"), F.sum(KEY).alias("key_sum"))


@query
def committee_decision(spark, sf):
    decided = decisions.with_committee(applications(spark, sf), MEMBERS)
    return decided.select(KEY, "decision", "confidence", "fraud_votes", "active_models")


@query
def committee_partial(spark, sf):
    """A member without a score for a row shrinks the committee of that row."""
    df = applications(spark, sf).select(KEY, LABEL, "month", *SCORES)
    gaps = df.withColumns(
        {
            "score_xgboost": F.when(F.col("month") < 6, F.col("score_xgboost")),
            "score_lightgbm": F.when(F.col("month") < 4, F.col("score_lightgbm")),
            "score_mlp": F.when(F.col("month") != 7, F.col("score_mlp")),
        }
    )
    decided = decisions.with_committee(gaps, MEMBERS)
    return decided.groupBy("active_models", "decision", "confidence").agg(
        F.count("*").alias("n"), F.sum(KEY).alias("key_sum")
    )


@query
def committee_votes(spark, sf):
    votes = decisions.vote_rows(applications(spark, sf), KEY, MEMBERS)
    return votes.groupBy("model", "vote").agg(
        F.count("*").alias("n"), F.sum(KEY).alias("key_sum"), F.max("threshold").alias("threshold")
    )


@query
def committee_details(spark, sf):
    decided = decisions.with_committee(applications(spark, sf), MEMBERS, details=True)
    parts = []
    for m in MEMBERS:
        cell = F.col("committee")[m]
        parts += [cell["score"].alias(f"{m}_score"), cell["vote_fraud"].alias(f"{m}_vote")]
    return decided.select(KEY, "decision", *parts)


@query
def outcome_counts(spark, sf):
    decided = decisions.with_committee(applications(spark, sf), MEMBERS)
    return decisions.outcome_counts(decided, LABEL)


@query
def cost_report(spark, sf):
    return decisions.cost_report(
        decisions.with_committee(applications(spark, sf), MEMBERS), LABEL
    )


@query
def mix_cost_report(spark, sf):
    df = applications(spark, sf).select(KEY, LABEL, *SCORES)
    mix = sampling.class_quota_sample(df, KEY, LABEL, MIX, "mix")
    return decisions.cost_report(decisions.with_committee(mix, MEMBERS), LABEL)


# ---- features ---------------------------------------------------------------------


def _fitted(spark, sf):
    train = applications(spark, sf, "train")
    return train, applications(spark, sf), features.fit_clip_bounds(train, ROLES)


@query
def clip_bounds(spark, sf):
    _, _, bounds = _fitted(spark, sf)
    rows = [(c, lo, hi) for c, (lo, hi) in bounds.items()]
    return profile.small_table(spark, rows, "feature string, lower double, upper double")


@query
def engineered_features(spark, sf):
    _, df, bounds = _fitted(spark, sf)
    made = features.engineer(df, ROLES, bounds)
    numeric, categorical = features.engineered_names(ROLES, df.columns)
    return made.select(
        KEY,
        *[F.col(c).cast("double").alias(c) for c in numeric],
        *categorical,
    )


@query
def robust_scaled(spark, sf):
    train, df, bounds = _fitted(spark, sf)
    numeric, categorical = features.engineered_names(ROLES, df.columns)
    prep = preprocess.RobustPrep(columns=numeric, categories=categorical)
    model = prep.fit(features.engineer(train, ROLES, bounds))
    scaled = model.transform(features.engineer(df, ROLES, bounds))
    # converted once per row, not once per slot
    arrays = scaled.select(KEY, vector_to_array(preprocess.NUMBERS).alias("x"))
    return arrays.select(KEY, *[F.col("x")[i].alias(c) for i, c in enumerate(numeric)])


@query
def one_hot(spark, sf):
    """Levels learned without one payment type, so that some rows hold an unseen one;
    gaps in the housing status are a level of their own."""
    df = applications(spark, sf).select(KEY, "split", "month", "income", *CATEGORICAL)
    df = df.withColumn("housing_status", F.when(F.col("month") != 0, F.col("housing_status")))
    unseen = F.when(F.col("payment_type") != "AE", F.col("payment_type"))
    fit_on = df.where("split = 'train'").withColumn("payment_type", F.coalesce(unseen, F.lit("AD")))
    fill = preprocess.RobustPrep(columns=["income"], categories=CATEGORICAL)
    stages = [fill, *preprocess.preprocess_stages(ROLES, CATEGORICAL)[2:4]]
    coded = Pipeline(stages=stages).fit(fit_on).transform(df)
    slots = []
    for c in CATEGORICAL:
        levels = coded.schema[f"{c}{preprocess.HOT}"].metadata["ml_attr"]["attrs"]
        names = [a["name"] for group in levels.values() for a in sorted(group, key=lambda a: a["idx"])]
        slots += [F.col(c)[i].cast("int").alias(f"{c}_{n}") for i, n in enumerate(names)]
    # converted once per row, not once per slot
    arrays = [vector_to_array(F.col(f"{c}{preprocess.HOT}")).alias(c) for c in CATEGORICAL]
    return coded.select(KEY, *arrays).select(KEY, *slots)


# ---- models -------------------------------------------------------------------------

# Two engines do not fit the same floats, so model queries return the rows scored with
# what must hold for each: a probability, and a ranking better than the floor.
AUC_FLOOR = 0.6
FLOORS = {"dt": 0.5}  # one deep tree with a few features per node


def _checked(scored: DataFrame, floor: float | None = AUC_FLOOR) -> DataFrame:
    scored = materialize(scored.select(KEY, LABEL, "score"), "scored")
    reached = floor is None or training.exact_auc(scored, LABEL) >= floor
    return scored.select(
        KEY,
        LABEL,
        F.coalesce(F.col("score").between(0, 1), F.lit(False)).alias("is_score"),
        F.lit(bool(reached)).alias("auc_reached"),
    )


def _fitted_scores(spark, sf, name, split="test", **fit_args):
    train = applications(spark, sf, "train")
    spec = models.MODELS[name]
    model = training.fit_pipeline(train, spec, spec.defaults, **fit_args)
    return model, training.score(model, applications(spark, sf, split), name, [KEY, LABEL])


def _score_query(query_name, model):
    def run(spark, sf):
        floor = FLOORS.get(model, AUC_FLOOR)
        return _checked(_fitted_scores(spark, sf, model)[1], floor)

    run.__name__ = query_name
    query(run)


for _query, _model in {
    "lr_scores": "logreg",
    "tree_scores": "dt",
    "rf_scores": "rf",
    "gbt_scores": "xgb",
    "gbt_leaf_scores": "lgbm",
    "mlp_scores": "mlp",
}.items():
    _score_query(_query, _model)


@query
def iforest_scores(spark, sf):
    """Scores of the rows fitted on: from 0 to 1, both reached."""
    _, scored = _fitted_scores(spark, sf, "if", "train")
    scored = materialize(scored, "scored")
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    return _checked(scored, None).withColumn("spans_range", F.lit(low == 0 and high == 1))


@query
def lr_search(spark, sf):
    """The whole grid, cross-validated; what is found lies in it and ranks above the floor."""
    spec = models.MODELS["logreg"]
    best, auc, _ = training.search(applications(spark, sf, "train"), spec)
    tried = len(spec.candidates())
    rows = [(tried, best in spec.candidates(), auc >= AUC_FLOOR)]
    return profile.small_table(spark, rows, "n_tried int, in_grid boolean, auc_reached boolean")


def _random_search(spark, sf, model):
    """The model's own random search: its whole space and all of its draws."""
    spec = models.MODELS[model]
    drawn = spec.candidates(SETTINGS.seed)
    best, auc, _ = training.search(applications(spark, sf, "train"), spec)
    rows = [(len(drawn), best in drawn, auc >= AUC_FLOOR)]
    return profile.small_table(spark, rows, "n_tried int, in_space boolean, auc_reached boolean")


@query
def gbt_random_search(spark, sf):
    return _random_search(spark, sf, "xgb")


@query
def undersampled_scores(spark, sf):
    return _checked(_fitted_scores(spark, sf, "logreg", undersampling_ratio=0.2)[1])


@query
def rf_importance(spark, sf):
    """Importances of the forest: sorted, not negative, 1 in all."""
    train = applications(spark, sf, "train")
    spec = models.MODELS["rf"]
    model = training.fit_pipeline(train, spec, spec.defaults)
    names = preprocess.feature_names(model.transform(train.limit(1)))
    listed = [r["importance"] for r in explain.importances(spark, model.stages[-1], names).collect()]
    every = explain.importances(spark, model.stages[-1], names, top=len(names))
    total = every.agg(F.sum("importance")).first()[0]
    rows = [(len(listed), listed == sorted(listed, reverse=True) and listed[-1] >= 0, round(total, DIGITS))]
    return profile.small_table(spark, rows, "n_listed int, is_sorted boolean, total double")


@query
def lr_explanations(spark, sf):
    """Per row: all terms and the intercept add up to the model's raw score."""
    model, _ = _fitted_scores(spark, sf, "logreg")
    scored = model.transform(applications(spark, sf, "test"))
    names = preprocess.feature_names(scored)
    terms = explain.linear_terms(model.stages[-1], names, top=len(names))
    total = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t["term"]) + model.stages[-1].intercept
    raw = vector_to_array(F.col("logreg__raw"))[1]
    adds_up = F.abs(total - raw) <= 1e-6 * (1 + F.abs(raw))
    return scored.select(KEY, F.size(terms).alias("n_terms") == len(names), adds_up.alias("adds_up")).toDF(
        KEY, "all_terms", "adds_up"
    )


@query
def stacked_scores(spark, sf):
    train, test = applications(spark, sf, "train"), applications(spark, sf, "test")
    bases = {n: models.MODELS[n].defaults for n in models.STACK_REQUIRED}
    stack, _ = training.fit_stack(train, bases)
    return _checked(training.score(stack, test, models.STACKING, [KEY, LABEL]))


# Whole numbers with few values: every value is a cut.
TREE_FEATURES = {
    "month": range(8), "prev_address_months_count": range(-1, 8), "customer_age": range(10, 100, 10),
    "date_of_birth_distinct_emails_4w": range(40), "keep_alive_session": range(2),
}
TREE = boosting.Boost(
    rounds=1, learning_rate=0.3, max_depth=0, num_leaves=5, min_child_weight=5.0, min_child_rows=30,
    reg_alpha=0.5, reg_lambda=2.0, class_weights=(1.0, 3.0),
)


NETWORK = perceptron.Perceptron(hidden=(2,), activation="tanh")
NETWORK_WEIGHTS = (0.3, -0.2, 0.1, 0.4, 0.05, -0.1, 0.7, -0.5, 0.2)


@query
def mlp_gradient(spark, sf):
    """Loss (place -1) and gradient of a small network over all train rows, weighted and repeated."""
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) / s for c, s in (("month", 4), ("customer_age", 50))]
    rows = applications(spark, sf, "train").select(
        KEY, LABEL, (1 + 2 * F.col(LABEL)).alias("w"), array_to_vector(F.array(*x)).alias("features")
    )
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))))
    nets = [(NETWORK, np.array(NETWORK_WEIGHTS))]
    found = []
    for name, table, weight in (("weighted", rows, F.col("w")), ("repeated", copies, None)):
        ((loss, slope),) = perceptron.gradients(table, nets, LABEL, KEY, weight=weight)
        found += [(name, place, round(float(v), DIGITS)) for place, v in enumerate([loss, *slope], -1)]
    return profile.small_table(spark, found, "rows string, place int, value double")


LOGISTIC_C = (0.1, 1.0, 10.0)


@query
def lr_coefficients(spark, sf):
    """Coefficients (the intercept is the last) for both penalties, each fold left out and no fold (-1)."""
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) / s for c, s in (("customer_age", 50), ("keep_alive_session", 1))]
    rows = applications(spark, sf, "train").select(
        KEY, LABEL, (F.col(KEY) % 3).cast("int").alias("fold"), (1 + 20 * F.col(LABEL)).alias("w"),
        array_to_vector(F.array(*x)).alias("features"),
    )
    hows = [
        logistic.Logistic(C=c, penalty=penalty, without_fold=fold)
        for fold in (*range(3), None) for penalty in ("l1", "l2") for c in LOGISTIC_C
    ]
    found = []
    for how, model in zip(hows, logistic.fit(rows, hows, LABEL, KEY, weight=F.col("w"), fold="fold")):
        fold = -1 if how.without_fold is None else how.without_fold
        values = [*model.coefficients, model.intercept]
        found += [(fold, how.penalty, how.C, n, round(float(v), DIGITS)) for n, v in enumerate(values)]
    return profile.small_table(spark, found, "without_fold int, penalty string, c double, place int, value double")


@query
def boost_leafwise_trees(spark, sf):
    """First trees of three folds and of all rows, grown together best leaf first: splits and leaves."""
    rows = applications(spark, sf, "train").select(
        KEY, LABEL, (F.col(KEY) % 3).cast("int").alias("fold"),
        array_to_vector(F.array(*(F.col(c).cast("double") for c in TREE_FEATURES))).alias("features"),
    )
    models_of = [*range(3), None]
    hows = [replace(TREE, without_fold=fold) for fold in models_of]
    cuts = [np.array(values, float) for values in TREE_FEATURES.values()]
    found = []
    for fold, model in zip(models_of, boosting.fit(rows, hows, LABEL, KEY, fold="fold", cuts=cuts)):
        nodes, paths = model.nodes().to_dict("records"), {0: ""}
        for n in nodes:
            path, split = paths[n["node"]], n["feature"] >= 0
            if split:
                paths[n["left"]], paths[n["right"]] = path + "L", path + "R"
            name = list(TREE_FEATURES)[n["feature"]] if split else None
            value = n["gain"] if split else n["value"]
            found.append(
                (-1 if fold is None else fold, path, name, n["cut"] if split else None, round(value, DIGITS))
            )
    schema = "without_fold int, path string, feature string, cut double, value double"
    return profile.small_table(spark, found, schema)


@query
def tuned_threshold(spark, sf):
    """The threshold of a hold-out: its F1 is that of its precision and recall."""
    train = applications(spark, sf, "train")
    spec = models.MODELS["logreg"]
    held = training.tune_threshold(train, spec, spec.defaults)
    p, r = held["precision"], held["recall"]
    rows = [(0 <= held["threshold"] <= 1, abs(held["fbeta"] - 2 * p * r / (p + r)) < 1e-6)]
    return profile.small_table(spark, rows, "is_threshold boolean, is_f1 boolean")


# ---- run facts ------------------------------------------------------------------------


@query
def split_roundtrip(spark, sf):
    """Write both splits as one dataset, read one split back through its folder."""
    store = Store(spark, new_path(spark, "store"))
    store.write_splits(applications(spark, sf).select(KEY, LABEL, "month", "split"))
    return _key_summary(store.read_split("test"), "split", "month")


def _monthly_points(spark, sf):
    return _points(spark, sf, by=("month",))


@query
def threshold_store(spark, sf):
    """Thresholds tuned per month as runs; the latest one counts, others default."""
    store = Store(spark, new_path(spark, "store"))
    best = curves.best_fbeta(_monthly_points(spark, sf), by=("month",))
    saved = best.where("model <> 'score_mlp'").select(
        "model",
        F.concat(F.lit("run_"), F.col("month").cast("string")).alias("run_id"),
        # a run without a usable threshold does not count
        F.when(F.col("month") < 7, F.col("threshold")).alias("threshold"),
        F.lit("holdout").alias("source"),
    )
    saved.write.mode("append").parquet(store.path("thresholds"))
    wanted = spark.createDataFrame([(s,) for s in SCORES], "model string")
    found = thresholds_for(wanted, store.thresholds())
    return found


def _monthly_runs(spark, sf):
    runs = curves.areas(_monthly_points(spark, sf), by=("month",))
    return runs.select(
        "model",
        F.concat(F.lit("run_"), F.col("month").cast("string")).alias("run_id"),
        F.lit("1").alias("evaluated_at"),
        "roc_auc",
        "pr_auc",
    )


@query
def experiment_latest(spark, sf):
    """Latest run per model with its evaluation; a run without one stays empty."""
    runs = _monthly_runs(spark, sf)
    evaluated = runs.where("model <> 'score_mlp' OR run_id <> 'run_7'")
    return latest_evaluation(runs.select("model", "run_id"), evaluated)


@query
def experiment_leaderboard(spark, sf):
    return leaderboard(_monthly_runs(spark, sf))


@query
def report_sections(spark, sf):
    df = applications(spark, sf)
    store = Store(spark, new_path(spark, "store"))
    store.write_report("target", profile.target_distribution(df, LABEL))
    store.write_report("monthly", profile.rate_by_period(df, ROLES.period, LABEL))
    sections = report_section(store.read_report("target"), "target", LABEL)
    return sections.unionByName(report_section(store.read_report("monthly"), "monthly", "month"))


@query
def csv_roundtrip(spark, sf):
    """Write the raw schema as CSV under the label's other name, read it back with the
    declared types and the usual name."""
    path = new_path(spark, "csv")
    df = applications(spark, sf).select(KEY, *RAW_COLUMNS).withColumnRenamed(LABEL, "is_fraud")
    df.write.option("header", True).csv(path)
    kinds = raw_schema(KEY)
    schema = T.StructType([T.StructField(n, kinds[LABEL if n == "is_fraud" else n].dataType) for n in df.columns])
    back = with_label(read_table(spark, path, "csv", schema), LABEL)
    return back.groupBy("month", "housing_status").agg(
        F.count("*").alias("n"),
        F.sum(LABEL).alias("pos"),
        F.sum("zip_count_4w").alias("zip_sum"),
        F.max("velocity_24h").alias("velocity_max"),
    )


# ---- streams ---------------------------------------------------------------------------


def _committee(df):
    return decisions.with_committee(df, MEMBERS)


@query
def stream_decisions(spark, sf):
    """The application files as a stream; totals equal the batch result."""
    source = applications(spark, sf)
    stream = streams.read_stream(spark, prepared_path(spark, sf), source.schema)
    out, checkpoint = new_path(spark, "decided"), new_path(spark, "stream")
    narrow = stream.select(KEY, LABEL, *SCORES)
    streams.finished(streams.write_decisions(narrow, _committee, LABEL, out, checkpoint))
    decided = spark.read.parquet(out)
    return decided.groupBy("decision", "outcome").agg(
        F.count("*").alias("n"), F.sum(KEY).alias("key_sum")
    )


@query
def stream_running_totals(spark, sf):
    source = applications(spark, sf)
    stream = streams.read_stream(spark, prepared_path(spark, sf), source.schema, files_per_batch=2)
    out, checkpoint = new_path(spark, "totals"), new_path(spark, "stream")
    narrow = stream.select(KEY, LABEL, *SCORES)
    streams.finished(streams.write_running_totals(narrow, _committee, LABEL, out, checkpoint))
    return spark.read.parquet(out)


@query
def stream_running_cost(spark, sf):
    """The cost report as streaming state, read from its newest version."""
    source = applications(spark, sf)
    stream = streams.read_stream(spark, prepared_path(spark, sf), source.schema, files_per_batch=2)
    out, checkpoint = new_path(spark, "cost"), new_path(spark, "stream")
    totals = decisions.cost_report(_committee(stream.select(KEY, LABEL, *SCORES)), LABEL)
    streams.finished(streams.write_versions(totals, out, checkpoint))
    return streams.read_newest(spark, out)


EVENT_THRESHOLD = 0.7


def _event_tiers(df):
    value = F.least(F.col("value") / F.lit(500.0), F.lit(0.999))
    return df.select(
        "event_id",
        "ts",
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_error"),
        decisions.three_tier(value, EVENT_THRESHOLD).alias("decision"),
    )


@query
def stream_event_tiers(spark, sf):
    """Three-tier decisions on the event files, by day."""
    schema = table(spark, sf, "events").schema
    stream = streams.read_stream(spark, f"{sf}/events.parque[t]", schema)
    out, checkpoint = new_path(spark, "events"), new_path(spark, "stream")
    streams.finished(streams.write_decisions(stream, _event_tiers, "is_error", out, checkpoint))
    decided = spark.read.parquet(out)
    return decided.groupBy(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), "decision", "outcome"
    ).agg(F.count("*").alias("n"), F.sum("event_id").alias("id_sum"))
