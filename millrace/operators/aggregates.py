"""Keyed aggregation, plain and in two salted phases, and key-skew profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import salt


@dataclass(frozen=True)
class Measure:
    """One aggregate: ``kind`` is sum, count, min, max or avg.

    ``scale`` asks for an exact sum of values with at most that many decimals:
    they are added as whole numbers of the last decimal place, so the result
    does not depend on partitioning, salting or task retries. Without it sums
    are ordinary double sums.
    """

    kind: str
    column: str = "*"
    scale: int | None = None

    def addend(self) -> Column:
        value = F.col(self.column)
        return value if self.scale is None else F.rint(value * 10.0**self.scale).cast("long")

    def total(self, added: Column) -> Column:
        return added if self.scale is None else added / F.lit(10.0**self.scale)

    def mean(self, added: Column, n: Column) -> Column:
        return self.total(added) / F.nullif(n, F.lit(0))


def one_phase(name: str, measure: Measure) -> Column:
    if measure.kind == "count":
        result = F.count(measure.column)
    elif measure.kind == "sum":
        result = measure.total(F.sum(measure.addend()))
    elif measure.kind == "avg":
        result = measure.mean(F.sum(measure.addend()), F.count(measure.column))
    elif measure.kind in ("min", "max"):
        result = getattr(F, measure.kind)(measure.column)
    else:
        raise ValueError(f"unknown measure kind: {measure.kind}")
    return result.alias(name)


def keyed_agg(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """One-phase aggregation; Spark already sums within each map task."""
    return df.groupBy(*keys).agg(*(one_phase(name, m) for name, m in measures.items()))


def salted_agg(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Measure],
    row_key: Sequence[str],
    buckets: int = 8,
) -> DataFrame:
    """The same result as :func:`keyed_agg`, over ``buckets`` sub-keys per key.

    The first phase groups by key and salt, the second merges the partials, so
    no task meets more than a share of a hot key. ``row_key`` should tell the
    rows of one key apart; it feeds the salt.
    """
    first: list[Column] = []
    merged: list[Column] = []
    for name, m in measures.items():
        part = f"_{name}"
        if m.kind == "count":
            first.append(F.count(m.column).alias(part))
            merged.append(F.sum(part).alias(name))
        elif m.kind == "sum":
            first.append(F.sum(m.addend()).alias(part))
            merged.append(m.total(F.sum(part)).alias(name))
        elif m.kind == "avg":
            first.append(F.sum(m.addend()).alias(part))
            first.append(F.count(m.column).alias(f"{part}_n"))
            merged.append(m.mean(F.sum(part), F.sum(f"{part}_n")).alias(name))
        elif m.kind in ("min", "max"):
            combine = getattr(F, m.kind)
            first.append(combine(m.column).alias(part))
            merged.append(combine(part).alias(name))
        else:
            raise ValueError(f"unknown measure kind: {m.kind}")
    partial = df.groupBy(*keys, salt(list(row_key), buckets).alias("_salt")).agg(*first)
    return partial.groupBy(*keys).agg(*merged)


def skew_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, with the key's share of all rows and ratio to the median key."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    overall = counts.agg(
        F.struct(
            F.sum("n_rows").alias("total"),
            F.percentile("n_rows", F.lit(0.5)).alias("median"),
        )
    ).scalar()
    return counts.select(
        *keys,
        "n_rows",
        (F.col("n_rows") / overall.getField("total")).alias("share_of_rows"),
        (F.col("n_rows") / overall.getField("median")).alias("times_median"),
    )


def top_by(df: DataFrame, measure: str, ties: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` largest rows; ``ties`` makes the choice among equals definite."""
    return df.orderBy(F.desc(measure), *ties).limit(n)


def rate(df: DataFrame, column: str, name: str) -> DataFrame:
    """Share of ones in a 0/1 column."""
    return df.agg(F.avg(column).alias(name))
