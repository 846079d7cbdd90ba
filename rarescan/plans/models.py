"""Model specifications: estimator, search space, class balancing."""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.ml import Estimator
from pyspark.ml.classification import RandomForestClassifier

from rarescan.operators.boosting import HistogramBooster
from rarescan.operators.forest import ForestClassifier
from rarescan.operators.isolation import IsolationForest
from rarescan.operators.logistic import PenalisedLogistic
from rarescan.operators.perceptron import PerceptronClassifier

NO_DEPTH_LIMIT = 30  # the deepest tree MLlib grows


@dataclass(frozen=True)
class FitContext:
    """What an estimator may need to know about the rows it is fitted on."""

    label: str
    key: str
    total_weight: float
    n_features: int
    weight_col: str | None
    seed: int = 42


@dataclass(frozen=True)
class ModelSpec:
    """One model: how to build it and what to search."""

    name: str
    build: Callable[[Mapping, FitContext], Estimator]
    space: Mapping[str, tuple] = field(default_factory=dict)
    defaults: Mapping = field(default_factory=dict)
    search: str | None = "grid"  # "grid", "random" or None
    draws: int = 0
    folds: int = 3
    search_rows: int = 100_000
    # "balanced", a fixed positive weight, "replicate" or None
    balance: str | float | None = "balanced"
    # a sample-weight balance that undersampling switches off
    balance_yields: bool = False

    def candidates(self, seed: int = 42, limit: int | None = None) -> list[dict]:
        """Parameter sets to try: all of the grid, or draws without replacement."""
        if self.search is None:
            return []
        names = list(self.space)
        sizes = [len(self.space[n]) for n in names]
        if self.search == "grid":
            sets = [dict(zip(names, v)) for v in itertools.product(*self.space.values())]
        else:
            total = math.prod(sizes)
            sets = []
            for number in random.Random(seed).sample(range(total), min(self.draws, total)):
                chosen = {}
                for n, size in zip(names, sizes):
                    number, at = divmod(number, size)
                    chosen[n] = self.space[n][at]
                sets.append(chosen)
        return sets[:limit]


def _outputs(name: str) -> dict[str, str]:
    return {
        "predictionCol": f"{name}__prediction",
        "probabilityCol": f"{name}__probability",
        "rawPredictionCol": f"{name}__raw",
    }


def _common(name: str, ctx: FitContext) -> dict:
    weight = {"weightCol": ctx.weight_col} if ctx.weight_col else {}
    return {"featuresCol": "features", "labelCol": ctx.label, **weight, **_outputs(name)}


def _boosted(name: str, ctx: FitContext, p: Mapping, **settings) -> Estimator:
    settings |= {
        "rounds": p["n_estimators"],
        "learning_rate": p["learning_rate"],
        "max_depth": p["max_depth"],
        "reg_alpha": p.get("reg_alpha", 0.0),
        "subsample": p["subsample"],
        "colsample": p["colsample"],
    }
    common = _common(name, ctx)
    return HistogramBooster(keyCol=ctx.key, settings=json.dumps(settings), **common)


def _logreg(p: Mapping, ctx: FitContext) -> Estimator:
    settings = {n: p[n] for n in ("C", "penalty", "max_iter") if n in p}
    return PenalisedLogistic(keyCol=ctx.key, settings=json.dumps(settings), **_common("logreg", ctx))


def _depth(value) -> int:
    return NO_DEPTH_LIMIT if value is None or value < 0 else min(value, NO_DEPTH_LIMIT)


def _tree(p: Mapping, ctx: FitContext) -> Estimator:
    # one tree with a feature subset per node
    return RandomForestClassifier(
        numTrees=1,
        bootstrap=False,
        maxDepth=_depth(p["max_depth"]),
        minInstancesPerNode=max(1, p["min_samples_split"] // 2),
        impurity=p["criterion"],
        featureSubsetStrategy=p["max_features"],
        seed=ctx.seed,
        **_common("dt", ctx),
    )


def _forest(p: Mapping, ctx: FitContext) -> Estimator:
    settings = {
        "trees": p["n_estimators"],
        "max_depth": _depth(p["max_depth"]),
        "min_rows": max(p["min_samples_leaf"], p["min_samples_split"] // 2),
        "max_features": str(p["max_features"]),
        "seed": ctx.seed,
    }
    return ForestClassifier(keyCol=ctx.key, settings=json.dumps(settings), **_common("rf", ctx))


def _boost_a(p: Mapping, ctx: FitContext) -> Estimator:
    return _boosted(
        "xgb",
        ctx,
        p,
        min_child_weight=p["min_child_weight"],
        min_gain=p["min_gain"],
        reg_lambda=p.get("reg_lambda", 1.0),
        seed=ctx.seed,
    )


def _boost_b(p: Mapping, ctx: FitContext) -> Estimator:
    return _boosted(
        "lgbm",
        ctx,
        p,
        num_leaves=p["num_leaves"],
        min_child_rows=p["min_child_samples"],
        min_child_weight=1e-3,
        reg_lambda=p.get("reg_lambda", 0.0),
        seed=ctx.seed + 1,
    )


def _perceptron(p: Mapping, ctx: FitContext) -> Estimator:
    names = ("hidden", "activation", "alpha", "learning_rate", "batch", "epochs", "patience")
    settings = {n: p[n] for n in names if n in p} | {"seed": ctx.seed}
    return PerceptronClassifier(keyCol=ctx.key, settings=json.dumps(settings), **_common("mlp", ctx))


def _isolation(p: Mapping, ctx: FitContext) -> Estimator:
    return IsolationForest(
        keyCol=ctx.key,
        scoreCol="if__score",
        trees=p["n_estimators"],
        contamination=p["contamination"],
        seed=ctx.seed,
    )


# Search spaces, draws, sample sizes and class balancing per model.
MODELS: dict[str, ModelSpec] = {
    spec.name: spec
    for spec in (
        ModelSpec(
            name="logreg",
            build=_logreg,
            space={"C": (0.001, 0.01, 0.1, 1, 10), "penalty": ("l1", "l2")},
            defaults={"C": 0.1, "penalty": "l2"},
        ),
        ModelSpec(
            name="dt",
            build=_tree,
            space={
                "max_depth": (5, 10, 15, None),
                "min_samples_split": (2, 5, 10),
                "criterion": ("gini", "entropy"),
                "max_features": ("sqrt", "log2"),
            },
            defaults={
                "max_depth": 10,
                "min_samples_split": 10,
                "criterion": "gini",
                "max_features": "sqrt",
            },
            search_rows=200_000,
        ),
        ModelSpec(
            name="rf",
            build=_forest,
            space={
                "n_estimators": (100, 200, 300, 500),
                "max_depth": (5, 10, 15, 20, 30, None),
                "min_samples_split": (2, 5, 10),
                "min_samples_leaf": (1, 2, 5, 10),
                "max_features": ("sqrt", "log2", 0.3, 0.5),
            },
            defaults={
                "n_estimators": 100,
                "max_depth": 10,
                "min_samples_split": 2,
                "min_samples_leaf": 5,
                "max_features": "sqrt",
            },
            search="random",
            draws=40,
            search_rows=200_000,
        ),
        ModelSpec(
            name="xgb",
            build=_boost_a,
            space={
                "learning_rate": (0.01, 0.03, 0.05, 0.1, 0.15),
                "n_estimators": (100, 200, 300, 500),
                "max_depth": (3, 4, 5, 6, 7, 8),
                "min_child_weight": (1, 3, 5, 7),
                "subsample": (0.6, 0.7, 0.8, 0.9, 1.0),
                "colsample": (0.6, 0.7, 0.8, 0.9, 1.0),
                "min_gain": (0.0, 0.1, 0.3, 0.5, 1.0),
                "reg_alpha": (0, 0.01, 0.1, 1.0),
                "reg_lambda": (0.1, 0.5, 1.0, 5.0),
            },
            defaults={
                "learning_rate": 0.1,
                "n_estimators": 100,
                "max_depth": 4,
                "min_child_weight": 1,
                "subsample": 0.8,
                "colsample": 0.8,
                "min_gain": 0.0,
                "reg_alpha": 0.0,
                "reg_lambda": 1.0,
            },
            search="random",
            draws=60,
            balance=90.0,
        ),
        ModelSpec(
            name="mlp",
            build=_perceptron,
            space={
                "hidden": (
                    (64,),
                    (128,),
                    (256,),
                    (128, 64),
                    (256, 128),
                    (64, 32),
                    (128, 64, 32),
                ),
                "activation": ("relu", "tanh"),
                "alpha": (0.0001, 0.001, 0.01, 0.1),
                "learning_rate": (0.0005, 0.001, 0.005, 0.01),
                "batch": (256, 512),
            },
            defaults={
                "hidden": (64, 32),
                "activation": "relu",
                "alpha": 0.0001,
                "learning_rate": 0.001,
                "batch": 256,
            },
            search="random",
            draws=20,
            balance_yields=True,
        ),
        ModelSpec(
            name="if",
            build=_isolation,
            defaults={"n_estimators": 200, "contamination": 0.01},
            search=None,
            balance=None,
        ),
        ModelSpec(
            name="lgbm",
            build=_boost_b,
            space={
                "learning_rate": (0.01, 0.03, 0.05, 0.1),
                "n_estimators": (100, 200, 300, 500, 700),
                "max_depth": (-1, 3, 5, 7, 10),
                "num_leaves": (15, 31, 63, 127),
                "min_child_samples": (5, 10, 20, 50),
                "subsample": (0.6, 0.7, 0.8, 0.9, 1.0),
                "colsample": (0.6, 0.7, 0.8, 0.9, 1.0),
                "reg_alpha": (0, 0.01, 0.1, 1.0),
                "reg_lambda": (0, 0.1, 1.0, 5.0),
            },
            defaults={
                "learning_rate": 0.05,
                "n_estimators": 200,
                "max_depth": 5,
                "num_leaves": 31,
                "min_child_samples": 20,
                "subsample": 0.8,
                "colsample": 0.8,
                "reg_alpha": 0.0,
                "reg_lambda": 0.0,
            },
            search="random",
            draws=60,
        ),
    )
}

# Models whose folds and candidates share their passes.
BOOSTED = ("xgb", "lgbm")

# The stacking ensemble.
STACKING = "stacking"
STACK_REQUIRED = ("xgb", "rf")
STACK_OPTIONAL = ("lgbm", "logreg")
STACK_FOLDS = 5
STACK_C = 1.0


def choose_models(names: list[str]) -> list[str]:
    """Model names to train; ``all`` is every model but the stack."""
    if names == ["all"]:
        return list(MODELS)
    unknown = [n for n in names if n not in MODELS and n != STACKING]
    if unknown:
        raise ValueError(f"unknown models {unknown}; known: {[*MODELS, STACKING]}")
    return list(dict.fromkeys(names))


def scoring_model(names: list[str]) -> str:
    """The model that scores by default: the first boosting model, else the first named."""
    return "xgb" if "xgb" in names else names[0]
