"""Feature step: presence flags, clipping, risk flags and interactions.

Fitting learns clip bounds only; transforming is one projection of column
expressions with those bounds as literals.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarescan.config import BANK_APPLICATIONS, Roles
from rarescan.functions.columns import clip, flag
from rarescan.operators.quantiles import exact_quantiles

CLIP_PROBS = (0.01, 0.99)


def _num(name: str) -> Column:
    return F.col(name).cast("double")


def _per(top: Column, bottom: Column) -> Column:
    # null where the denominator is 0; the imputer fills it later
    return F.try_divide(top, bottom)


@dataclass(frozen=True)
class Interaction:
    """A column made from others; left out when an input is missing."""

    name: str
    inputs: tuple[str, ...]
    build: Callable[..., Column]


# The interactions of the bank preset and their formulas.
INTERACTIONS = (
    Interaction(
        "digital_risk_score",
        ("email_is_free", "device_distinct_emails_8w"),
        lambda free, emails: free * emails,
    ),
    Interaction(
        "velocity_anomaly", ("velocity_6h", "velocity_4w"), lambda now, usual: _per(now, usual + 1)
    ),
    Interaction(
        "credit_utilization",
        ("intended_balcon_amount", "proposed_credit_limit"),
        lambda amount, limit: _per(amount, limit + 1),
    ),
    Interaction("age_income_risk", ("customer_age", "income"), lambda age, income: age * income),
    Interaction(
        "multi_risk_flag",
        ("is_high_risk_housing", "is_high_risk_os", "email_is_free"),
        lambda housing, system, free: (housing * system * free).cast("byte"),
    ),
    Interaction(
        "phone_mismatch",
        ("phone_home_valid", "phone_mobile_valid"),
        # an unknown phone differs from anything
        lambda home, mobile: F.coalesce(home != mobile, F.lit(True)).cast("byte"),
    ),
    Interaction(
        "email_velocity_risk",
        ("email_is_free", "velocity_6h"),
        lambda free, velocity: free * velocity,
    ),
    Interaction(
        "address_stability",
        ("current_address_months_count", "customer_age"),
        lambda months, age: _per(months, age * 12 + 1),
    ),
)


def unmarked(roles: Roles, name: str) -> Column:
    """The column as double, with the missing marker turned into null."""
    if name in roles.marker_flags:
        return F.nullif(_num(name), F.lit(float(roles.marker_value)))
    return _num(name)


def fit_clip_bounds(df: DataFrame, roles: Roles, **quantile_args) -> dict[str, list[float]]:
    """1 % and 99 % quantiles of the columns to clip, markers and nulls left out."""
    present = [(c, unmarked(roles, c)) for c in roles.clipped if c in df.columns]
    bounds = exact_quantiles(df, present, CLIP_PROBS, **quantile_args)
    return {c: q for c, q in bounds.items() if q[0] is not None}


def engineer(df: DataFrame, roles: Roles, bounds: dict[str, list[float]]) -> DataFrame:
    """Apply the feature step with fitted bounds."""
    df = df.drop(*[c for c in roles.no_signal if c in df.columns])
    marked = [c for c in roles.marker_flags if c in df.columns]
    presence = {
        roles.marker_flags[c]: F.when(
            F.col(c).eqNullSafe(F.lit(roles.marker_value)), 0
        ).otherwise(1).cast("byte")
        for c in marked
    }
    cleaned = {c: unmarked(roles, c) for c in marked}
    for c, (low, high) in bounds.items():
        if c in df.columns:
            cleaned[c] = clip(unmarked(roles, c), low, high)
    risky = {
        name: flag(F.col(c) == value)
        for c, (value, name) in roles.risk_flags.items()
        if c in df.columns
    }
    df = df.withColumns(presence | cleaned | risky)
    made = {
        i.name: i.build(*[_num(c) for c in i.inputs])
        for i in INTERACTIONS
        if all(c in df.columns for c in i.inputs)
    }
    return df.withColumns(made) if made else df


def engineered_names(roles: Roles, columns) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature names after the feature step."""
    columns = set(columns)
    numeric = [c for c in roles.numeric if c in columns and c not in roles.no_signal]
    numeric += [f for c, f in roles.marker_flags.items() if c in columns]
    numeric += [f for c, (_, f) in roles.risk_flags.items() if c in columns]
    known = columns | set(numeric)
    numeric += [i.name for i in INTERACTIONS if all(c in known for c in i.inputs)]
    return numeric, [c for c in roles.categorical if c in columns]


def roles_to_json(roles: Roles) -> str:
    return json.dumps(asdict(roles))


def roles_from_json(text: str) -> Roles:
    raw = json.loads(text)
    for name in ("numeric", "categorical", "no_signal", "clipped"):
        raw[name] = tuple(raw[name])
    raw["risk_flags"] = {c: tuple(v) for c, v in raw["risk_flags"].items()}
    return Roles(**raw)


class _HasRoles(Params):
    """Roles kept as a JSON param, so that ML persistence stores them."""

    roles = Param(Params._dummy(), "roles", "column roles as JSON", TypeConverters.toString)

    def getRoles(self) -> Roles:
        return roles_from_json(self.getOrDefault(self.roles))


class FeatureStep(Estimator, _HasRoles, DefaultParamsReadable, DefaultParamsWritable):
    """Learns clip bounds on the rows it is fitted on."""

    @keyword_only
    def __init__(self, *, roles: str | None = None):
        super().__init__()
        self._setDefault(roles=roles_to_json(BANK_APPLICATIONS))
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> FeatureStepModel:
        bounds = fit_clip_bounds(dataset, self.getRoles())
        model = FeatureStepModel(bounds=json.dumps(bounds), roles=self.getOrDefault(self.roles))
        return model._resetUid(self.uid)


class FeatureStepModel(Model, _HasRoles, DefaultParamsReadable, DefaultParamsWritable):
    bounds = Param(Params._dummy(), "bounds", "clip bounds as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, bounds: str | None = None, roles: str | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def getBounds(self) -> dict[str, list[float]]:
        return json.loads(self.getOrDefault(self.bounds))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return engineer(dataset, self.getRoles(), self.getBounds())
