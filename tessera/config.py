"""Job parameters and the fixed values of the churn data contract.

Everything a notebook widget used to carry is a plain dataclass field here;
jobs take the dataclass (or keyword overrides), never global state.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the reference pipeline's for equal results.
# ---------------------------------------------------------------------------
RAW_COLUMNS = (
    "customer_id", "gender", "senior_citizen", "partner", "dependents",
    "tenure_months", "phone_service", "internet_service", "contract_type",
    "paperless_billing", "payment_method", "monthly_charges", "total_charges",
    "churn",
)
TEXT_COLUMNS = (
    "gender", "partner", "dependents", "phone_service", "internet_service",
    "contract_type", "paperless_billing", "payment_method",
)
INT_COLUMNS = ("senior_citizen", "tenure_months")
DOUBLE_COLUMNS = ("monthly_charges", "total_charges")
LABEL_COLUMN = "churn"
ID_COLUMN = "customer_id"
YES_NO_COLUMNS = ("partner", "dependents", "phone_service", "paperless_billing")
ONE_HOT_VOCABULARY = {
    "internet_service": ("dsl", "fiber optic", "no"),
    "contract_type": ("month-to-month", "one year", "two year"),
    "payment_method": ("electronic check", "mailed check", "bank transfer", "credit card"),
}
LONG_TENURE_MONTHS = 24
HIGH_SPENDER_MONTHLY = 75
SPLIT_TRAIN_BELOW = 8     # buckets 0..7 -> train
SPLIT_VAL_BUCKET = 8      # bucket 8 -> val, 9 -> test
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5)
# Default histogram bounds of the metrics client library (inference latency).
DEFAULT_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
ERROR_RATIO_YELLOW = 0.01
ERROR_RATIO_RED = 0.05
RULE_POSITIVE = (1, 0.85)
RULE_NEGATIVE = (0, 0.15)
RULE_SHORT_TENURE = 12
RULE_MISSING_TENURE = 99
RF_GRID = (
    {"n_estimators": 50, "max_depth": 5},
    {"n_estimators": 100, "max_depth": 8},
    {"n_estimators": 200, "max_depth": 12},
)
NN_GRID = (
    {"hidden_units": 32, "dropout": 0.2, "epochs": 30, "batch_size": 8},
    {"hidden_units": 64, "dropout": 0.3, "epochs": 50, "batch_size": 8},
    {"hidden_units": 128, "dropout": 0.4, "epochs": 50, "batch_size": 8},
)

# Gold feature names in the order the Gold job produces them.
GOLD_FEATURES = (
    "senior_citizen", "partner", "dependents", "tenure_months", "phone_service",
    "paperless_billing", "monthly_charges", "total_charges",
    "avg_charge_per_month", "is_long_tenure", "is_high_spender", "gender_male",
    "internet_service_dsl", "internet_service_fiber_optic", "internet_service_no",
    "contract_type_month_to_month", "contract_type_one_year", "contract_type_two_year",
    "payment_method_electronic_check", "payment_method_mailed_check",
    "payment_method_bank_transfer", "payment_method_credit_card",
)

# Scoring contract (V5-V8): numeric bounds, required 0/1 flags, defaulted one-hots.
CONTRACT_RANGES = {
    "tenure_months": (0, 120),
    "monthly_charges": (0.0, None),
    "total_charges": (0.0, None),
    "avg_charge_per_month": (0.0, None),
}
CONTRACT_REQUIRED_FLAGS = (
    "senior_citizen", "partner", "dependents", "phone_service", "paperless_billing",
    "gender_male", "is_long_tenure", "is_high_spender",
)
CONTRACT_DEFAULTED_FLAGS = (
    "internet_service_dsl", "internet_service_fiber_optic", "internet_service_no",
    "contract_type_month_to_month", "contract_type_one_year", "contract_type_two_year",
    "payment_method_electronic_check", "payment_method_mailed_check",
    "payment_method_bank_transfer", "payment_method_credit_card",
)
# ---------------------------------------------------------------------------

#: Contract numbers that have to be whole.
CONTRACT_INTEGERS = ("tenure_months",)


# What each layer's schema holds (comments of the catalog).
LAYER_SCHEMAS = {
    "bronze": "landing rows as text with their file and time of ingest",
    "silver": "one typed row per customer, and the quarantine",
    "gold": "features, label and split per customer",
    "models": "runs, model versions and aliases",
}


@dataclass(frozen=True)
class Layers:
    """Dataset locations of one project (catalog prefix + layer folders)."""

    root: str
    project: str = "churn"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.project}/{layer}/{table}"


@dataclass(frozen=True)
class JobConfig:
    """Parameters of the ingest/clean/feature/train/register jobs."""

    layers: Layers
    bronze_table: str = "customer_churn_raw"
    silver_table: str = "customer_churn"
    quarantine_table: str = "customer_churn_quarantine"
    gold_table: str = "customer_churn_features"
    experiment: str = "churn_experiments"
    registered_name: str = "churn_classifier"
    alias: str = "production"
    max_files_per_trigger: int | None = None
    silver_declared: tuple[str, ...] = ()  # columns beyond the landing contract that Silver accepts
    silver_extra: str = "fail"             # any other: fail, quarantine or keep
    keep_versions: int | None = None      # full rebuilds: versions kept per dataset (None = all)
    long_tenure: int = LONG_TENURE_MONTHS
    high_spender: float = HIGH_SPENDER_MONTHLY
    one_hot: dict = field(default_factory=lambda: dict(ONE_HOT_VOCABULARY))
