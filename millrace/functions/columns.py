"""Small null-safe column helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def is_yes(name: str) -> Column:
    return F.col(name).eqNullSafe("Yes").cast("int")


def to_number(name: str) -> Column:
    """Text to double; what is not a number (or reads NaN) becomes null."""
    return F.nanvl(F.col(name).try_cast("double"), F.lit(None))


def lookup(name: str, mapping: Mapping, default=None) -> Column:
    """Map values through a small dictionary; unknown and null give ``default``."""
    chain = None
    for key, value in mapping.items():
        branch = F.col(name) == key
        chain = F.when(branch, value) if chain is None else chain.when(branch, value)
    return chain if default is None else chain.otherwise(default)


def number_or_zero(name: str) -> Column:
    """Null and NaN both read as zero."""
    return F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(None)), F.lit(0.0))


def salt(row_key: list[str], buckets: int) -> Column:
    """A bucket number from the row's own key, so a retried task repeats it."""
    return F.pmod(F.xxhash64(*row_key), F.lit(buckets)).cast("int")
