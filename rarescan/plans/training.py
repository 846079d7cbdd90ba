"""Search, refit, threshold choice and stacking, the same way for every model."""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarescan.config import BANK_APPLICATIONS, SETTINGS, Roles, Settings
from rarescan.operators import boosting, curves, logistic, perceptron, sampling
from rarescan.operators.areas import exact_areas
from rarescan.operators.preprocess import preprocessor
from rarescan.plans.models import (
    BOOSTED,
    MODELS,
    STACK_C,
    STACK_FOLDS,
    STACK_REQUIRED,
    STACKING,
    FitContext,
    ModelSpec,
)
from rarescan.sources.shared import discard, materialize
from rarescan.sources.store import Store

WEIGHT = "weight"
PARALLEL_FITS = 4
# Models whose candidates and folds are fitted in the same passes.
SHARED_FITS = {**dict.fromkeys(BOOSTED, boosting.fit), "mlp": perceptron.fit, "logreg": logistic.fit}
JUDGED_AT_ONCE = 20  # candidates whose scores are columns of one table


@dataclass
class Trained:
    name: str
    model: PipelineModel
    params: Mapping
    cv_score: float | None
    cv_gap: float | None
    threshold: float
    holdout: Mapping = field(default_factory=dict)
    search_rows: int | None = None
    path: str | None = None


def score_column(name: str, columns: Sequence[str]) -> Column:
    """Probability of class 1 a fitted model of that name left in the table."""
    if f"{name}__probability" in columns:
        return vector_to_array(F.col(f"{name}__probability"))[1]
    return F.col(f"{name}__score")


def score(model, df: DataFrame, name: str, keep: Sequence[str] | None = None) -> DataFrame:
    """Batch scoring: the wanted input columns plus ``score``.

    The pipeline rewrites raw columns, so the originals travel in a struct;
    several models can then score one row after the other.
    """
    raw = F.struct(*(df.columns if keep is None else keep))
    out = model.transform(df.withColumn("__row", raw))
    return out.select("__row.*", score_column(name, out.columns).alias("score"))


def exact_auc(scored: DataFrame, label: str, column: str = "score") -> float:
    """ROC-AUC without binning."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=column, metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(scored.select(F.col(label).cast("double").alias(label), column))


def _width(df: DataFrame) -> int:
    attrs = df.schema["features"].metadata["ml_attr"]
    return int(attrs["num_attrs"])


def balanced_fit_input(
    df: DataFrame,
    spec: ModelSpec,
    roles: Roles,
    settings: Settings,
    undersampling_ratio: float | None,
) -> tuple[DataFrame, FitContext]:
    """Rows and weights a model is fitted on.  Scoring never sees this step."""
    label, key = roles.label, roles.key
    counts = sampling.class_counts(df, label)
    balance = spec.balance
    if spec.balance_yields and not sampling.use_sample_weights(True, undersampling_ratio):
        balance = None
    if undersampling_ratio is not None:
        df = sampling.undersample(
            df, key, label, undersampling_ratio, f"{settings.seed}-under", counts
        )
        counts = sampling.class_counts(df, label)
    if balance == "replicate":
        df = sampling.replicate_minority(df, key, label, f"{settings.seed}-copies", counts)
        balance = None
    total, weight = float(sum(counts.values())), None
    if balance is not None:
        weights = (
            sampling.balanced_weights(counts)
            if balance == "balanced"
            else sampling.positive_weight(float(balance))
        )
        df = sampling.with_weights(df, label, weights, WEIGHT)
        total, weight = float(sum(weights[c] * n for c, n in counts.items())), WEIGHT
    return df, FitContext(label, key, total, _width(df), weight, settings.seed)


def _prepared(df: DataFrame, prep: PipelineModel, roles: Roles) -> DataFrame:
    """Key, label and vector; at least one partition per core for iterative fits."""
    ready = prep.transform(df).select(roles.key, roles.label, "features")
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = ready.rdd.getNumPartitions() < cores
    return ready.repartition(cores, roles.key) if few else ready


def fit_pipeline(
    df: DataFrame,
    spec: ModelSpec,
    params: Mapping,
    roles: Roles = BANK_APPLICATIONS,
    settings: Settings = SETTINGS,
    undersampling_ratio: float | None = None,
) -> PipelineModel:
    """Preprocessing and model fitted on ``df`` as one scoring pipeline."""
    prep = preprocessor(roles, df.columns).fit(df)
    ready = _prepared(df, prep, roles).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows, ctx = balanced_fit_input(ready, spec, roles, settings, undersampling_ratio)
        model = spec.build(params, ctx).fit(rows)
    finally:
        ready.unpersist()
    return PipelineModel([*prep.stages, model])


def search(
    df: DataFrame,
    spec: ModelSpec,
    roles: Roles = BANK_APPLICATIONS,
    settings: Settings = SETTINGS,
    undersampling_ratio: float | None = None,
    candidates: Sequence[Mapping] | None = None,
) -> tuple[Mapping, float | None, float | None]:
    """Best parameters by mean cross-validated ROC-AUC; also the train/CV gap.

    Boosting, perceptrons and logistic regressions fit all candidates and folds in the same
    passes.  For other models, and with undersampling, preprocessing, which has nothing to search, is fitted
    once per fold and shared by all candidates; candidates of a fold run side by side.
    """
    candidates = spec.candidates(settings.seed) if candidates is None else list(candidates)
    if not candidates:
        return dict(spec.defaults), None, None
    if spec.name in SHARED_FITS and undersampling_ratio is None:
        means = shared_scores(df, spec, candidates, roles, settings)
        best = max(range(len(candidates)), key=lambda i: means[i][0])
        return dict(candidates[best]), means[best][0], means[best][1] - means[best][0]
    # written once: each fold reads its rows, not what they came from
    folded = sampling.with_folds(df, roles.key, spec.folds, f"{settings.seed}-cv")
    folded = materialize(folded, "search", ("fold",))
    scores: list[list[tuple[float, float]]] = [[] for _ in candidates]
    for fold in range(spec.folds):
        inside = folded.where(F.col("fold") != fold)
        outside = folded.where(F.col("fold") == fold)
        prep = preprocessor(roles, df.columns).fit(inside)
        train = _prepared(inside, prep, roles).persist(StorageLevel.MEMORY_AND_DISK)
        valid = _prepared(outside, prep, roles).persist(StorageLevel.MEMORY_AND_DISK)
        rows, ctx = balanced_fit_input(train, spec, roles, settings, undersampling_ratio)

        def evaluate(params, rows=rows, ctx=ctx, train=train, valid=valid):
            model = spec.build(params, ctx).fit(rows)
            return tuple(
                exact_auc(score(model, part, spec.name, [roles.label]), roles.label)
                for part in (valid, train)
            )

        with ThreadPool(min(PARALLEL_FITS, len(candidates))) as pool:
            for slot, result in zip(scores, pool.map(evaluate, candidates)):
                slot.append(result)
        train.unpersist()
        valid.unpersist()
    discard(folded)
    means = [tuple(sum(s) / spec.folds for s in zip(*slot)) for slot in scores]
    best = max(range(len(candidates)), key=lambda i: means[i][0])
    return dict(candidates[best]), means[best][0], means[best][1] - means[best][0]


def shared_scores(
    df: DataFrame, spec: ModelSpec, candidates: Sequence[Mapping], roles: Roles, settings: Settings
) -> list[tuple[float, float]]:
    """Per candidate the mean ROC-AUC over the folds, held out and on what was fitted.

    Preprocessing sees no label and is fitted once; the prepared table is written by fold.
    All candidates of all folds are an axis of the passes that fit them, and one table of
    scores judges many of them.  A part of one class, or without rows, counts as 0.5.
    """
    prep = preprocessor(roles, df.columns).fit(df)
    folded = sampling.with_folds(df, roles.key, spec.folds, f"{settings.seed}-cv")
    ready = prep.transform(folded).select(roles.key, roles.label, F.col("fold").cast("int"), "features")
    written = materialize(ready, "search", ("fold",))
    ctx = FitContext(roles.label, roles.key, 0.0, _width(ready), None, settings.seed)
    fitted = _shared_members(written, spec, candidates, range(spec.folds), roles, settings)
    if all(getattr(model, "areas", None) is not None for model in fitted):  # judged where they were fitted
        discard(written)
        areas = np.array([model.areas for model in fitted]).reshape(len(candidates), spec.folds, 2)
        return [tuple(map(float, mean)) for mean in areas.mean(axis=1)]
    sums: list[list[float]] = [[0.0, 0.0] for _ in candidates]
    for first in range(0, len(candidates), JUDGED_AT_ONCE):
        chosen = range(first, min(first + JUDGED_AT_ONCE, len(candidates)))
        parts = []
        for fold in range(spec.folds):
            scored = written.withColumn("held", (F.col("fold") == fold).cast("int"))
            for c in chosen:
                model = spec.build(candidates[c], ctx).model_of(fitted[c * spec.folds + fold])
                out = model.transform(scored)
                scored = out.select(*scored.columns, score_column(spec.name, out.columns).alias(f"c{c}"))
            parts.append(scored.select(F.lit(fold).alias("judged"), "held", roles.label, *(f"c{c}" for c in chosen)))
        judged = materialize(reduce(DataFrame.unionByName, parts), "judged")
        found = exact_areas(judged, [f"c{c}" for c in chosen], roles.label, by=["judged", "held"])
        for fold, held, c in itertools.product(range(spec.folds), (1, 0), chosen):
            auc = found.get((str(fold), str(held), f"c{c}"))
            sums[c][1 - held] += (0.5 if auc is None else auc) / spec.folds
        discard(judged)
    discard(written)
    return [tuple(s) for s in sums]


def tune_threshold(
    df: DataFrame,
    spec: ModelSpec,
    params: Mapping,
    roles: Roles = BANK_APPLICATIONS,
    settings: Settings = SETTINGS,
    undersampling_ratio: float | None = None,
    beta: float = 1.0,
    fit=None,
) -> dict:
    """Best F-beta threshold on a hold-out the model was not fitted on."""
    parts = sampling.with_split(
        df, roles.key, settings.holdout_fraction, f"{settings.seed}-holdout", "part"
    )
    inside = parts.where(F.col("part") == sampling.TRAIN).drop("part")
    outside = parts.where(F.col("part") == sampling.TEST).drop("part")
    fit = fit or (lambda rows: fit_pipeline(rows, spec, params, roles, settings, undersampling_ratio))
    scored = score(fit(inside), outside, spec.name, [roles.key, roles.label])
    scored = materialize(scored, "holdout")
    points = curves.curve_points(scored, ["score"], roles.label)
    best = curves.best_fbeta(points, beta).first()
    if best is None:
        raise ValueError("the hold-out is empty")
    area = curves.areas(points).first()["roc_auc"]
    discard(scored)
    return {**best.asDict(), "roc_auc": area}


def train(
    df: DataFrame,
    name: str,
    run_id: str,
    store: Store | None = None,
    roles: Roles = BANK_APPLICATIONS,
    settings: Settings = SETTINGS,
    undersampling_ratio: float | None = None,
    candidates: Sequence[Mapping] | None = None,
    logged_at: str | None = None,
) -> Trained:
    """Search on a subsample, refit on all rows, tune the threshold, save and log."""
    spec = MODELS[name]
    sample = sampling.stratified_subsample(
        df, roles.key, roles.label, spec.search_rows, f"{settings.seed}-search"
    )
    sample = materialize(sample, "sample")
    params, cv_score, gap = search(
        sample, spec, roles, settings, undersampling_ratio, candidates
    )
    searched = sample.count() if cv_score is not None else None
    discard(sample)
    model = fit_pipeline(df, spec, params, roles, settings, undersampling_ratio)
    held = tune_threshold(df, spec, params, roles, settings, undersampling_ratio)
    trained = Trained(
        name,
        model,
        params,
        cv_score,
        gap,
        held["threshold"],
        held,
        searched,
    )
    if store is not None:
        _record(store, trained, run_id, logged_at, undersampling_ratio)
    return trained


def _record(store, trained, run_id, logged_at, undersampling_ratio=None, extra=None) -> None:
    trained.path = store.save_model(trained.model, trained.name, run_id)
    store.save_threshold(trained.name, run_id, trained.threshold, "holdout")
    store.log_experiment(
        run_id=run_id,
        logged_at=logged_at or run_id,
        model=trained.name,
        best_params=trained.params,
        best_cv_score=trained.cv_score,
        train_cv_gap=trained.cv_gap,
        best_threshold=trained.threshold,
        model_path=trained.path,
        search_rows=trained.search_rows,
        undersampling_ratio=undersampling_ratio,
        extra=extra,
    )


# ---- stacking -----------------------------------------------------------------------


def _class_weights(spec: ModelSpec, counts: Mapping) -> tuple[float, float]:
    if spec.balance is None or spec.balance == "replicate":
        return 1.0, 1.0
    weights = (
        sampling.balanced_weights(counts)
        if spec.balance == "balanced"
        else sampling.positive_weight(float(spec.balance))
    )
    return tuple(float(weights.get(c, 1.0)) for c in (0, 1))


def _shared_members(ready, spec, candidates, folds, roles, settings) -> list:
    """Models of a spec of ``SHARED_FITS``, per candidate one without each of ``folds`` (None: all rows).

    All are fitted in the same passes over ``ready`` (key, label, fold, features).
    """
    counts = ready.groupBy("fold", F.col(roles.label).cast("int").alias("y")).count().collect()
    ctx = FitContext(roles.label, roles.key, 0.0, _width(ready), None, settings.seed)
    hows = []
    for params in candidates:
        how = spec.build(params, ctx).how()
        for fold in folds:
            left = Counter()
            for f, y, n in counts:
                left[y] += n if fold is None or f != fold else 0
            weights = _class_weights(spec, +left)
            hows.append(replace(how, without_fold=fold, class_weights=weights))
    return SHARED_FITS[spec.name](ready, hows, roles.label, roles.key, fold="fold")


def _fit_bases(ready, bases, folds, roles, settings) -> dict[str, list]:
    """Per base one model without each fold, and at last one of all rows.

    Boosting fits them in shared passes; other models fit side by side.
    """
    parts = [*range(folds), None]

    def boosted(name):
        spec = MODELS[name]
        ctx = FitContext(roles.label, roles.key, 0.0, _width(ready), None, settings.seed)
        estimator = spec.build(bases[name], ctx)
        found = _shared_members(ready, spec, [bases[name]], parts, roles, settings)
        return [(name, part, estimator.model_of(model)) for part, model in zip(parts, found)]

    def single(name, part):
        rows = ready if part is None else ready.where(F.col("fold") != part)
        rows, ctx = balanced_fit_input(rows, MODELS[name], roles, settings, None)
        return [(name, part, MODELS[name].build(bases[name], ctx).fit(rows))]

    jobs = [(boosted, (n,)) for n in bases if n in BOOSTED]
    jobs += [(single, (n, part)) for n in bases if n not in BOOSTED for part in parts]
    with ThreadPool(min(PARALLEL_FITS, len(jobs))) as pool:
        done = pool.map(lambda job: job[0](*job[1]), jobs, chunksize=1)
    fitted = {(name, part): model for models in done for name, part, model in models}
    return {name: [fitted[name, part] for part in parts] for name in bases}


def _chosen(bases) -> list[VectorSlicer]:
    """Each base's probability of class 1 as ``<name>__p``."""
    return [
        VectorSlicer(inputCol=f"{n}__probability", outputCol=f"{n}__p", indices=[1]) for n in bases
    ]


def _stack_bases(df, bases, roles, settings, folds) -> tuple[PipelineModel, DataFrame]:
    """Bases of all rows as one pipeline, and the out-of-fold scores (key, label, ``<name>__p``).

    Preprocessing, which sees no label, is fitted once on all rows; the prepared table is
    written once by fold.  All bases add their column to the same row, so nothing is joined.
    """
    folds = folds or STACK_FOLDS
    prep = preprocessor(roles, df.columns).fit(df)
    folded = sampling.with_folds(df, roles.key, folds, f"{settings.seed}-stack")
    # the fold travels beside the features: preprocessing does not know the column
    ready = prep.transform(folded).select(roles.key, roles.label, F.col("fold").cast("int"), "features")
    written = materialize(ready, "folds", ("fold",))
    fitted = _fit_bases(written, bases, folds, roles, settings)
    columns = [roles.key, roles.label, *[f"{n}__p" for n in bases]]
    parts = []
    for fold in range(folds):
        stages = [*(fitted[n][fold] for n in bases), *_chosen(bases)]
        scored = PipelineModel(stages).transform(written.where(F.col("fold") == fold))
        parts.append(scored.select(*columns))
    scores = materialize(reduce(DataFrame.unionByName, parts), "out-of-fold")
    discard(written)
    whole = PipelineModel([*prep.stages, *(fitted[n][-1] for n in bases), *_chosen(bases)])
    return whole, scores


def _fit_meta(scores: DataFrame, names: Sequence[str], roles: Roles) -> PipelineModel:
    assembler = VectorAssembler(inputCols=[f"{n}__p" for n in names], outputCol="base_scores")
    ready = assembler.transform(scores).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        meta = LogisticRegression(
            featuresCol="base_scores",
            labelCol=roles.label,
            regParam=1.0 / (STACK_C * ready.count()),
            standardization=False,
            maxIter=1000,
            predictionCol=f"{STACKING}__prediction",
            probabilityCol=f"{STACKING}__probability",
            rawPredictionCol=f"{STACKING}__raw",
        ).fit(ready)
    finally:
        ready.unpersist()
    return PipelineModel([assembler, meta])


def fit_stack(
    df: DataFrame,
    bases: Mapping[str, Mapping],
    roles: Roles = BANK_APPLICATIONS,
    settings: Settings = SETTINGS,
    folds: int | None = None,
) -> tuple[PipelineModel, float]:
    """Stack over base models (name -> parameters) and its out-of-fold ROC-AUC.

    Base models and the logistic regression on their probabilities are one pipeline,
    saved, loaded and scored like any other model.
    """
    missing = [n for n in STACK_REQUIRED if n not in bases]
    if missing or len(bases) < 2:
        raise ValueError(f"a stack needs {STACK_REQUIRED} and at least two models")
    fitted, scores = _stack_bases(df, bases, roles, settings, folds)
    meta = _fit_meta(scores, list(bases), roles)
    judged = meta.transform(scores)
    judged = judged.select(roles.label, score_column(STACKING, judged.columns).alias("score"))
    auc = exact_auc(judged, roles.label)
    return PipelineModel([*fitted.stages, *meta.stages]), auc


def train_stack(
    df: DataFrame,
    bases: Mapping[str, Mapping],
    run_id: str,
    store: Store | None = None,
    roles: Roles = BANK_APPLICATIONS,
    settings: Settings = SETTINGS,
    folds: int | None = None,
    logged_at: str | None = None,
) -> Trained:
    """Fit, tune on a hold-out, save and log the stack."""
    model, oof_auc = fit_stack(df, bases, roles, settings, folds)
    spec = ModelSpec(name=STACKING, build=None, search=None)
    held = tune_threshold(
        df,
        spec,
        {},
        roles,
        settings,
        fit=lambda rows: fit_stack(rows, bases, roles, settings, folds)[0],
    )
    params = {"bases": {n: dict(p) for n, p in bases.items()}, "folds": folds or STACK_FOLDS, "C": STACK_C}
    trained = Trained(STACKING, model, params, oof_auc, None, held["threshold"], held)
    if store is not None:
        _record(store, trained, run_id, logged_at, extra={"n_base_learners": len(bases)})
    return trained
