"""Mergeable profiles of rows: counts, means and squared deviations per column.

A profile of a batch is computed in one pass and stored, one row per column. Profiles of
many batches merge into that of all their rows, so moments of a training table and reports
over any set of batches need no second look at rows. Deviations are merged about the
common mean, so nothing cancels out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.quality import flag_drift, is_missing
from millrace.settings import Settings

PROFILE = (
    "position int, feature string, n_rows long, n long, mean double, m2 double, "
    "missing long, negative long"
)


def profile(df: DataFrame, columns: Sequence[str] | None = None, groups: Sequence[str] = ()) -> DataFrame:
    """One row per column (and group): rows, values, their mean and squared deviations
    ``m2`` from it, missing and negative values. NaN counts as missing; the mean of a
    column that holds no number is null."""
    names = [c for c in (columns or df.columns) if c not in groups]
    aggregates, cells = [F.count("*").alias("n_rows")], []
    for i, name in enumerate(names):
        zero = F.lit(0).cast("long")
        n, mean, m2, negative = zero, F.lit(None).cast("double"), F.lit(0.0), zero
        if isinstance(df.schema[name].dataType, T.NumericType):
            value = F.nanvl(F.col(name).cast("double"), F.lit(None))
            aggregates += [
                F.count(value).alias(f"{i}_n"),
                F.avg(value).alias(f"{i}_mean"),
                F.var_pop(value).alias(f"{i}_var"),
                F.count_if(value < 0).alias(f"{i}_negative"),
            ]
            n, mean, negative = F.col(f"{i}_n"), F.col(f"{i}_mean"), F.col(f"{i}_negative")
            m2 = F.coalesce(F.col(f"{i}_var") * n, F.lit(0.0))
        aggregates.append(F.count_if(is_missing(df, name)).alias(f"{i}_missing"))
        cells.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("feature"),
                F.col("n_rows"),
                n.alias("n"),
                mean.alias("mean"),
                m2.alias("m2"),
                F.col(f"{i}_missing").alias("missing"),
                negative.alias("negative"),
            )
        )
    wide = df.groupBy(*groups).agg(*aggregates) if groups else df.agg(*aggregates)
    return wide.select(*groups, F.inline(F.array(*cells)))


def merged(profiles: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The profile of all rows behind some profiles, per group; as many rows as columns and groups.

    A column that some profiles lack counts their rows as none, not as missing.
    """
    keys = [*groups, "position", "feature"]
    totals = profiles.groupBy(*keys).agg(
        *(F.sum(c).alias(c) for c in ("n_rows", "n", "missing", "negative")),
        (F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("mean"),
    )
    whole = totals.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("mean").alias("_mean"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    off = F.col("mean") - F.col("_mean")
    spread = (
        profiles.join(whole, same)
        .groupBy(*(F.col(f"_{k}") for k in keys))
        .agg(F.sum(F.col("m2") + F.coalesce(F.col("n") * off * off, F.lit(0.0))).alias("m2"))
    )
    return totals.join(spread, same).select(
        *groups, "position", "feature", "n_rows", "n", "mean", "m2", "missing", "negative"
    )


def moments(profiles: DataFrame) -> DataFrame:
    """Profile rows with ``std``, the sample standard deviation (null for a single value)."""
    freedom = F.when(F.col("n") > 1, F.col("n") - 1)
    return profiles.withColumn("std", F.sqrt(F.col("m2") / freedom))


def drift_from_profiles(
    train: DataFrame, recent: DataFrame, settings: Settings = Settings(), groups: Sequence[str] = ()
) -> DataFrame:
    """The drift report of two profiles; ``recent`` may hold one per group."""
    features = list(settings.drift_features)
    place = F.array_position(F.lit(features), F.col("feature")).cast("int") - 1
    now = recent.where(F.col("feature").isin(features)).select(
        *groups, place.alias("position"), "feature", F.col("mean").alias("recent_mean")
    )
    return flag_drift(moments(train), now, settings, groups)


def issues(profiles: DataFrame, settings: Settings = Settings(), groups: Sequence[str] = ()) -> DataFrame:
    """The quality report of a profile: rows checked, issue messages, whether it passed."""
    limit = settings.max_missing_fraction
    fraction = F.col("missing") / F.nullif("n_rows", F.lit(0))
    signed = list(settings.non_negative_columns)

    def message(bad: Column, order: Column, template: str, *values: Column) -> Column:
        return F.when(bad, F.struct(order.alias("place"), F.format_string(template, F.col("feature"), *values).alias("text")))

    missing = message(
        fraction > limit,
        F.col("position"),
        f"Column '%s' has %.2f%% missing values (> {limit * 100:.0f}%% threshold)",
        F.round(fraction * 100, 2),
    )
    below = message(
        F.col("feature").isin(signed) & (F.col("negative") > 0),
        F.lit(1 << 30) + F.array_position(F.lit(signed), F.col("feature")).cast("int"),
        "Column '%s' has %d out-of-range (negative) values",
        F.col("negative"),
    )
    found = F.array_compact(F.flatten(F.collect_list(F.array(missing, below))))
    report = profiles.groupBy(*groups).agg(F.max("n_rows").alias("n_rows_checked"), F.array_sort(found).alias("found"))
    return report.select(
        *groups,
        "n_rows_checked",
        F.transform("found", lambda one: one["text"]).alias("issues"),
        (F.size("found") == 0).alias("passed"),
    )
