"""Imputation, robust scaling, one-hot coding and assembly after the feature step."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarescan.config import BANK_APPLICATIONS, Roles
from rarescan.operators.features import FeatureStep, engineered_names, roles_to_json
from rarescan.operators.quantiles import exact_quantiles

MISSING = "missing"
QUARTILES = (0.25, 0.5, 0.75)
# A spread below this counts as no spread; the divisor is then 1.
NO_SPREAD = 10 * 2.220446049250313e-16
NUMBERS, CODE, HOT = "numbers", "__code", "__hot"


def fit_numeric(df: DataFrame, columns: list[str], **quantile_args) -> dict[str, dict]:
    """Median for nulls, then centre and spread of the filled column.

    Filling piles rows up at the median, which pulls the quartiles in, so
    columns with nulls get their quartiles from the filled values.
    """
    seen = df.agg(F.count("*").alias("rows"), *[F.count(c).alias(c) for c in columns]).first()
    counts = [seen[c] for c in columns]
    quartiles = exact_quantiles(df, columns, QUARTILES, counts=counts, **quantile_args)
    # A column without any value fills with 0.
    medians = {c: 0.0 if q[1] is None else q[1] for c, q in quartiles.items()}
    refit = [
        (c, F.coalesce(F.col(c).cast("double"), F.lit(medians[c])))
        for c in columns
        if seen[c] < seen["rows"]
    ]
    if refit:
        counts = [seen["rows"]] * len(refit)
        quartiles |= exact_quantiles(df, refit, QUARTILES, counts=counts, **quantile_args)
    out = {}
    for c in columns:
        low, middle, high = quartiles[c]
        spread = high - low
        out[c] = {
            "fill": medians[c],
            "centre": middle,
            "spread": 1.0 if spread < NO_SPREAD else spread,
        }
    return out


class RobustPrep(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Median fill and (x - median) / IQR for numbers; a fill value for categories."""

    columns = Param(Params._dummy(), "columns", "numeric columns", TypeConverters.toListString)
    categories = Param(
        Params._dummy(), "categories", "categorical columns", TypeConverters.toListString
    )

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None, categories: list[str] | None = None):
        super().__init__()
        self._setDefault(columns=[], categories=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> RobustPrepModel:
        fitted = fit_numeric(dataset, self.getOrDefault(self.columns))
        model = RobustPrepModel(
            fitted=json.dumps(fitted), categories=self.getOrDefault(self.categories)
        )
        return model._resetUid(self.uid)


class RobustPrepModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    fitted = Param(Params._dummy(), "fitted", "fitted numbers as JSON", TypeConverters.toString)
    categories = Param(
        Params._dummy(), "categories", "categorical columns", TypeConverters.toListString
    )

    @keyword_only
    def __init__(self, *, fitted: str | None = None, categories: list[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def getFitted(self) -> dict[str, dict]:
        return json.loads(self.getOrDefault(self.fitted))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = {
            c: F.coalesce(F.col(c), F.lit(MISSING)) for c in self.getOrDefault(self.categories)
        }
        out = dataset.withColumns(filled) if filled else dataset
        return out.withColumn(NUMBERS, self.scaled())

    def scaled(self) -> Column:
        """All numbers as one vector, whose metadata names the slots.

        One expression over an array: as forty separate columns the generated
        code gets too long for the JIT compiler.
        """
        fitted = self.getFitted()
        values = F.array(*[F.col(c).cast("double") for c in fitted])
        fill, centre, spread = (
            F.array(*[F.lit(float(f[part])) for f in fitted.values()])
            for part in ("fill", "centre", "spread")
        )
        whole = F.transform(
            values,
            lambda x, i: (F.coalesce(x, F.get(fill, i)) - F.get(centre, i)) / F.get(spread, i),
        )
        slots = [{"idx": i, "name": c} for i, c in enumerate(fitted)]
        names = {"ml_attr": {"attrs": {"numeric": slots}, "num_attrs": len(slots)}}
        return array_to_vector(whole).alias(NUMBERS, metadata=names)


def preprocess_stages(roles: Roles = BANK_APPLICATIONS, columns=None) -> list:
    """Stages from raw columns to the ``features`` vector.

    Unseen categories code as all zeros; every fitted level keeps its column.
    """
    numeric, categorical = engineered_names(roles, columns or roles.features)
    coded = [f"{c}{CODE}" for c in categorical]
    hot = [f"{c}{HOT}" for c in categorical]
    stages = [
        FeatureStep(roles=roles_to_json(roles)),
        RobustPrep(columns=numeric, categories=categorical),
    ]
    if categorical:
        stages += [
            StringIndexer(
                inputCols=categorical,
                outputCols=coded,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            # the slot for unseen values is last, and dropLast drops it
            OneHotEncoder(inputCols=coded, outputCols=hot, dropLast=True),
        ]
    return [*stages, VectorAssembler(inputCols=[NUMBERS, *hot], outputCol="features")]


def preprocessor(roles: Roles = BANK_APPLICATIONS, columns=None) -> Pipeline:
    return Pipeline(stages=preprocess_stages(roles, columns))


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's slots, from the metadata the assembler leaves."""
    attrs = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [n.removeprefix(f"{NUMBERS}_").replace(f"{HOT}_", "=") for _, n in slots]
