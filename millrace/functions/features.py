"""The one definition of the model features, used by training and scoring alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.columns import flag, is_yes, lookup, number_or_zero

# Upper (inclusive) edges of the tenure buckets and the encodings.
TENURE_EDGES = [6, 12, 24, 48, 10_000]
PAYMENT_CODES = {"electronic_check": 0, "mailed_check": 1, "bank_transfer": 2, "credit_card": 3}
INTERNET_CODES = {"none": 0, "dsl": 1, "fiber_optic": 2}
HIGH_VALUE_CHARGE = 80.0


def tenure_bucket(name: str = "tenure_months") -> Column:
    """Right-closed buckets (-1,6] (6,12] (12,24] (24,48] (48,10000]; null outside."""
    tenure = F.col(name)
    chain = F.when(tenure <= -1, None)
    for number, edge in enumerate(TENURE_EDGES):
        chain = chain.when(tenure <= edge, number)
    return chain


def with_defaults(df: DataFrame) -> DataFrame:
    """Add absent input columns as 0 and fill the numeric ones."""
    present = set(df.columns)
    absent = {
        name: F.lit("0" if name in schemas.CATEGORICAL + schemas.ADDONS else 0)
        for name in schemas.RAW_FEATURES
        if name not in present
    }
    df = df.withColumns(absent) if absent else df
    return df.withColumns(
        {
            **{name: number_or_zero(name) for name in schemas.NUMERIC},
            **{name: number_or_zero(name).cast("int") for name in schemas.FLAGS},
        }
    )


def engineer_features(df: DataFrame) -> DataFrame:
    """All input columns plus the eight derived ones; row-local, no shuffle."""
    # A tenure of -1 is outside every bucket; the null divisor keeps its ratio
    # null too instead of failing the whole job.
    per_month = F.col("total_charges") / F.nullif(F.col("tenure_months") + 1, F.lit(0.0))
    addons = sum((is_yes(name) for name in schemas.ADDONS[1:]), is_yes(schemas.ADDONS[0]))
    return with_defaults(df).withColumns(
        {
            "tenure_bucket": tenure_bucket(),
            "charges_per_tenure_month": per_month,
            "monthly_rate_deviation": F.col("monthly_charges") - per_month,
            "num_addon_services": addons,
            "is_month_to_month": flag(F.col("contract_type") == "month_to_month"),
            "high_value_customer": flag(F.col("monthly_charges") > HIGH_VALUE_CHARGE),
            "internet_service_encoded": lookup("internet_service", INTERNET_CODES, default=0),
            "payment_method_encoded": lookup("payment_method", PAYMENT_CODES, default=-1),
        }
    )


def to_model_matrix(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 17 model columns in their fixed order, after any columns to ``keep``."""
    return engineer_features(df).select(*keep, *schemas.MODEL_FEATURES)
