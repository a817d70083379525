"""Column roles: which columns are ids, dates, codes, numbers and categories.

Operators never hard-code a column name; they read it from a ``RoleMap``.  ``LOAN_ROLES`` is
the ready-made map for the 32-column origination and 32-column performance files.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# The positional layout of the two delimited files.
ORIGINATION_COLUMNS = (
    "credit_score",
    "first_payment_date",
    "first_time_homebuyer_flag",
    "maturity_date",
    "msa",
    "mi_percentage",
    "number_of_units",
    "occupancy_status",
    "original_cltv",
    "original_dti",
    "original_upb",
    "original_ltv",
    "original_interest_rate",
    "channel",
    "prepayment_penalty_flag",
    "amortization_type",
    "property_state",
    "property_type",
    "postal_code",
    "loan_sequence_number",
    "loan_purpose",
    "original_loan_term",
    "number_of_borrowers",
    "seller_name",
    "servicer_name",
    "super_conforming_flag",
    "pre_relief_refinance_loan_sequence_number",
    "special_eligibility_program",
    "relief_refinance_indicator",
    "property_valuation_method",
    "interest_only_indicator",
    "mi_cancellation_indicator",
)
PERFORMANCE_COLUMNS = (
    "loan_sequence_number",
    "monthly_reporting_period",
    "current_actual_upb",
    "current_loan_delinquency_status",
    "loan_age",
    "remaining_months_to_legal_maturity",
    "defect_settlement_date",
    "modification_flag",
    "zero_balance_code",
    "zero_balance_effective_date",
    "current_interest_rate",
    "current_non_interest_bearing_upb",
    "due_date_last_paid_installment",
    "mi_recoveries",
    "net_sale_proceeds",
    "non_mi_recoveries",
    "total_expenses",
    "legal_costs",
    "maintenance_preservation_costs",
    "taxes_insurance",
    "miscellaneous_expenses",
    "actual_loss_calculation",
    "cumulative_modification_cost",
    "interest_rate_step_indicator",
    "payment_deferral_flag",
    "estimated_ltv",
    "zero_balance_removal_upb",
    "delinquent_accrued_interest",
    "delinquency_due_to_disaster",
    "borrower_assistance_status_code",
    "current_month_modification_cost",
    "interest_bearing_upb",
)
LIGHT_PERFORMANCE_COLUMNS = ("loan_sequence_number", "zero_balance_code")


@dataclass(frozen=True)
class RoleMap:
    """Names and value rules of one origination/performance table pair."""

    loan_id: str
    event_code: str
    period: str
    first_payment: str
    maturity: str
    term: str
    state: str
    target: str = "default"
    year: str = "year"
    default_codes: tuple[int, ...] = ()
    numeric: tuple[str, ...] = ()
    integer_like: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    encoded: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()
    leaky: tuple[str, ...] = ()
    not_features: tuple[str, ...] = ()
    mixed_text: tuple[str, ...] = ()
    numeric_sentinels: Mapping[str, tuple[int, ...]] = field(default_factory=dict)
    category_sentinels: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    summary_sentinels: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    value_sets: Mapping[str, tuple[int, ...]] = field(default_factory=dict)
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    id_pattern: str = ".*"
    state_pattern: str = ".*"
    unknown: str = "UNKNOWN"

    @property
    def dates(self) -> tuple[str, str]:
        return (self.first_payment, self.maturity)

    @property
    def date_features(self) -> tuple[str, ...]:
        parts = [f"{d}_{part}" for d in self.dates for part in ("year", "month")]
        return (*parts, "loan_term_months")

    @property
    def numeric_features(self) -> tuple[str, ...]:
        plain = [c for c in self.numeric if c not in self.not_features]
        return (*plain, *self.date_features)

    @property
    def features(self) -> tuple[str, ...]:
        return (*self.numeric_features, *self.encoded)


# Code lists, sentinels, ranges and domains of the loan files.
LOAN_ROLES = RoleMap(
    loan_id="loan_sequence_number",
    event_code="zero_balance_code",
    period="monthly_reporting_period",
    first_payment="first_payment_date",
    maturity="maturity_date",
    term="original_loan_term",
    state="property_state",
    default_codes=(2, 3, 9),
    numeric=(
        "credit_score",
        "msa",
        "mi_percentage",
        "number_of_units",
        "original_cltv",
        "original_dti",
        "original_upb",
        "original_ltv",
        "original_interest_rate",
        "original_loan_term",
        "number_of_borrowers",
    ),
    integer_like=(
        "number_of_units",
        "number_of_borrowers",
        "original_loan_term",
        "postal_code",
        "msa",
    ),
    categorical=(
        "first_time_homebuyer_flag",
        "occupancy_status",
        "channel",
        "prepayment_penalty_flag",
        "amortization_type",
        "property_state",
        "property_type",
        "loan_sequence_number",
        "loan_purpose",
        "seller_name",
        "servicer_name",
        "interest_only_indicator",
    ),
    encoded=(
        "first_time_homebuyer_flag",
        "occupancy_status",
        "channel",
        "prepayment_penalty_flag",
        "amortization_type",
        "property_state",
        "property_type",
        "loan_purpose",
        "interest_only_indicator",
    ),
    dropped=(
        "super_conforming_flag",
        "pre_relief_refinance_loan_sequence_number",
        "relief_refinance_indicator",
        "property_valuation_method",
        "mi_cancellation_indicator",
        "special_eligibility_program",
    ),
    leaky=tuple(c for c in PERFORMANCE_COLUMNS if c != "loan_sequence_number"),
    not_features=("seller_name", "servicer_name", "postal_code", "msa"),
    mixed_text=(
        "special_eligibility_program",
        "relief_refinance_indicator",
        "property_valuation_method",
        "interest_only_indicator",
        "mi_cancellation_indicator",
        "super_conforming_flag",
        "pre_relief_refinance_loan_sequence_number",
    ),
    numeric_sentinels={
        "credit_score": (9999,),
        "mi_percentage": (999,),
        "number_of_units": (99,),
        "original_cltv": (999,),
        "original_dti": (999,),
        "original_ltv": (999,),
        "number_of_borrowers": (99,),
    },
    category_sentinels={
        "first_time_homebuyer_flag": ("9",),
        "occupancy_status": ("9",),
        "channel": ("9",),
        "property_type": ("99",),
        "loan_purpose": ("9",),
    },
    summary_sentinels={
        "credit_score": ("9999",),
        "mi_percentage": ("999",),
        "number_of_units": ("99",),
        "first_time_homebuyer_flag": ("9",),
        "occupancy_status": ("9",),
        "channel": ("9",),
        "property_type": ("99",),
        "loan_purpose": ("9",),
        "original_cltv": ("999",),
        "original_dti": ("999",),
        "original_ltv": ("999",),
        "number_of_borrowers": ("99",),
        "special_eligibility_program": ("9",),
        "property_valuation_method": ("7",),
        "mi_cancellation_indicator": ("7", "9"),
    },
    ranges={
        "credit_score": (300, 850),
        "original_dti": (1, 65),
        "original_ltv": (6, 105),
        "original_cltv": (6, 200),
        "mi_percentage": (0, 55),
    },
    value_sets={
        "number_of_units": (1, 2, 3, 4),
        "number_of_borrowers": (1, 2),
        "default": (0, 1),
    },
    allowed={
        "first_time_homebuyer_flag": ("N", "UNKNOWN", "Y"),
        "occupancy_status": ("I", "P", "S", "UNKNOWN"),
        "channel": ("B", "C", "R", "T", "UNKNOWN"),
        "prepayment_penalty_flag": ("N", "Y"),
        "amortization_type": ("ARM", "FRM"),
        "property_type": ("CO", "CP", "MH", "PU", "SF", "UNKNOWN"),
        "loan_purpose": ("C", "N", "P", "R", "UNKNOWN"),
        "interest_only_indicator": ("N", "Y"),
    },
    id_pattern=r"^[FA]\d{2}Q[1-4]\d{7}$",
    state_pattern=r"^[A-Z]{2}$",
)
