"""Raw customer rows to the clean customer table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.columns import is_yes, lookup, to_number


def clean_customers(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename, repair blank totals, normalise categories, turn Yes/No into 1/0.

    An unknown category becomes null and stays visible to the record check; a
    blank or unreadable total takes the monthly charge (the first bill).
    ``keep`` names further columns to carry along unchanged.
    """
    named = raw.withColumnsRenamed(schemas.RENAMES)
    yes_no = [*schemas.YES_NO_FLAGS, "multiple_lines", "churn"]
    return named.withColumns(
        {
            "total_charges": F.coalesce(to_number("total_charges"), F.col("monthly_charges")),
            "contract_type": lookup("contract_type", schemas.CONTRACT_TYPES),
            "payment_method": lookup("payment_method", schemas.PAYMENT_METHODS),
            "internet_service": lookup("internet_service", schemas.INTERNET_SERVICES),
            **{name: is_yes(name) for name in yes_no},
        }
    ).select(*schemas.CUSTOMER_COLUMNS, *keep)
