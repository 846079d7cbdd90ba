"""Column roles and fixed settings.

Every operator takes the names it works on as arguments; ``Roles`` bundles them
for a whole table.  ``BANK_APPLICATIONS`` is the preset for bank-account
applications with a binary fraud label.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    seed: int = 42
    test_fraction: float = 0.2
    holdout_fraction: float = 0.2
    default_threshold: float = 0.5


@dataclass(frozen=True)
class Roles:
    key: str
    label: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    no_signal: tuple[str, ...] = ()
    clipped: tuple[str, ...] = ()
    # column -> name of the presence flag; marker_value stands for "missing"
    marker_flags: Mapping[str, str] = field(default_factory=dict)
    marker_value: int = -1
    # column -> (risky value, flag name)
    risk_flags: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    period: str | None = None

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical


# Column names, roles and risky categories of the preset.
BANK_APPLICATIONS = Roles(
    key="application_id",
    label="fraud_bool",
    numeric=(
        "income",
        "name_email_similarity",
        "prev_address_months_count",
        "current_address_months_count",
        "customer_age",
        "days_since_request",
        "intended_balcon_amount",
        "zip_count_4w",
        "velocity_6h",
        "velocity_24h",
        "velocity_4w",
        "bank_branch_count_8w",
        "date_of_birth_distinct_emails_4w",
        "credit_risk_score",
        "email_is_free",
        "phone_home_valid",
        "phone_mobile_valid",
        "bank_months_count",
        "has_other_cards",
        "proposed_credit_limit",
        "foreign_request",
        "session_length_in_minutes",
        "keep_alive_session",
        "device_distinct_emails_8w",
        "device_fraud_count",
        "month",
    ),
    categorical=(
        "payment_type",
        "employment_status",
        "housing_status",
        "source",
        "device_os",
    ),
    no_signal=("device_fraud_count", "session_length_in_minutes"),
    clipped=(
        "proposed_credit_limit",
        "intended_balcon_amount",
        "bank_branch_count_8w",
        "prev_address_months_count",
    ),
    marker_flags={
        "prev_address_months_count": "has_prev_address",
        "bank_months_count": "has_bank_history",
        "device_distinct_emails_8w": "has_device_emails",
    },
    risk_flags={
        "housing_status": ("BA", "is_high_risk_housing"),
        "employment_status": ("CC", "is_high_risk_employment"),
        "device_os": ("windows", "is_high_risk_os"),
        "payment_type": ("AC", "is_high_risk_payment"),
        "source": ("TELEAPP", "is_teleapp_source"),
    },
    period="month",
)

SETTINGS = Settings()
