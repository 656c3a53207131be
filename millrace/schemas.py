"""Table schemas, fixed value lists and the record domain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TELEMETRY = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("vehicle_model", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("engine_temp_c", T.DoubleType()),
        T.StructField("speed_kmph", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("battery_efficiency", T.DoubleType()),
        T.StructField("miles_driven", T.DoubleType()),
    ]
)

# Raw column name -> clean column name.
RENAMES = {
    "customerID": "customer_id",
    "tenure": "tenure_months",
    "MonthlyCharges": "monthly_charges",
    "TotalCharges": "total_charges",
    "Contract": "contract_type",
    "PaymentMethod": "payment_method",
    "InternetService": "internet_service",
    "OnlineSecurity": "online_security",
    "OnlineBackup": "online_backup",
    "DeviceProtection": "device_protection",
    "TechSupport": "tech_support",
    "StreamingTV": "streaming_tv",
    "StreamingMovies": "streaming_movies",
    "SeniorCitizen": "senior_citizen",
    "Partner": "partner",
    "Dependents": "dependents",
    "PhoneService": "phone_service",
    "MultipleLines": "multiple_lines",
    "PaperlessBilling": "paperless_billing",
    "Churn": "churn",
}

# Raw category -> clean category.
CONTRACT_TYPES = {
    "Month-to-month": "month_to_month",
    "One year": "one_year",
    "Two year": "two_year",
}
PAYMENT_METHODS = {
    "Electronic check": "electronic_check",
    "Mailed check": "mailed_check",
    "Bank transfer (automatic)": "bank_transfer",
    "Credit card (automatic)": "credit_card",
}
INTERNET_SERVICES = {
    "DSL": "dsl",
    "Fiber optic": "fiber_optic",
    "No": "none",
}

ADDONS = [
    "online_security",
    "online_backup",
    "device_protection",
    "tech_support",
    "streaming_tv",
    "streaming_movies",
]
NUMERIC = ["tenure_months", "monthly_charges", "total_charges"]
CATEGORICAL = ["contract_type", "payment_method", "internet_service"]
FLAGS = [
    "senior_citizen",
    "partner",
    "dependents",
    "phone_service",
    "multiple_lines",
    "paperless_billing",
]
YES_NO_FLAGS = ["partner", "dependents", "phone_service", "paperless_billing"]

RAW_FEATURES = NUMERIC + CATEGORICAL + ADDONS + FLAGS
CUSTOMER_COLUMNS = ["customer_id", *RAW_FEATURES, "churn"]

# Fixed order: the columns of the model matrix.
MODEL_FEATURES = [
    "tenure_months",
    "monthly_charges",
    "total_charges",
    "senior_citizen",
    "partner",
    "dependents",
    "phone_service",
    "multiple_lines",
    "paperless_billing",
    "internet_service_encoded",
    "tenure_bucket",
    "charges_per_tenure_month",
    "monthly_rate_deviation",
    "num_addon_services",
    "is_month_to_month",
    "high_value_customer",
    "payment_method_encoded",
]


def _customer_type(name: str) -> T.DataType:
    if name in ("monthly_charges", "total_charges"):
        return T.DoubleType()
    if name == "tenure_months" or name in FLAGS or name == "churn":
        return T.IntegerType()
    return T.StringType()


CUSTOMER = T.StructType(
    [T.StructField(name, _customer_type(name)) for name in CUSTOMER_COLUMNS]
)

# Raw files: two numbers are typed, the total stays text because it can be blank.
_RAW_TYPES = {
    "tenure": T.IntegerType(),
    "SeniorCitizen": T.IntegerType(),
    "MonthlyCharges": T.DoubleType(),
}
RAW_CUSTOMER = T.StructType(
    [T.StructField(name, _RAW_TYPES.get(name, T.StringType())) for name in RENAMES]
)


@dataclass(frozen=True)
class Between:
    """A required number with inclusive bounds; ``None`` leaves a side open."""

    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class OneOf:
    """A required value from a fixed list."""

    values: tuple


@dataclass(frozen=True)
class Required:
    """Any value but null."""


_ADDON_STATES = OneOf(("Yes", "No", "No internet service"))

# The record domain shared by batch and stream: one rule per required field.
CUSTOMER_DOMAIN = {
    "customer_id": Required(),
    "tenure_months": Between(0, 100),
    "monthly_charges": Between(0),
    "total_charges": Between(0),
    "contract_type": OneOf(tuple(CONTRACT_TYPES.values())),
    "payment_method": OneOf(tuple(PAYMENT_METHODS.values())),
    "internet_service": OneOf(tuple(INTERNET_SERVICES.values())),
    **{name: _ADDON_STATES for name in ADDONS},
    **{name: Between(0, 1) for name in FLAGS},
}
