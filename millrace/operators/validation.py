"""Record checks against a declared domain."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas


def _holds(name: str, rule) -> Column:
    value = F.col(name)
    if isinstance(rule, schemas.OneOf):
        return value.isin(*rule.values)
    if isinstance(rule, schemas.Between):
        # NaN sorts above every number, so an open upper side must exclude it.
        checks = [~F.isnan(value.cast("double"))]
        if rule.low is not None:
            checks.append(value >= rule.low)
        if rule.high is not None:
            checks.append(value <= rule.high)
        holds = checks[0]
        for check in checks[1:]:
            holds = holds & check
        return holds
    return value.isNotNull()


def failed_fields(df: DataFrame, domain: Mapping = schemas.CUSTOMER_DOMAIN) -> Column:
    """Names of the fields outside their domain; a null or absent field fails."""
    present = set(df.columns)
    return F.array_compact(
        F.array(
            *(
                F.when(F.coalesce(_holds(name, rule), F.lit(False)), None).otherwise(name)
                if name in present
                else F.lit(name)
                for name, rule in domain.items()
            )
        )
    )


def check_records(df: DataFrame, domain: Mapping = schemas.CUSTOMER_DOMAIN) -> DataFrame:
    """Every row with ``failed_fields`` and ``is_valid``; batch or stream."""
    return df.withColumn("failed_fields", failed_fields(df, domain)).withColumn(
        "is_valid", F.size("failed_fields") == 0
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where("is_valid").drop("failed_fields", "is_valid")


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.where("not is_valid").drop("is_valid")
