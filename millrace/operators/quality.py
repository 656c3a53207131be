"""Data quality issues and mean drift, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.settings import Settings


# The wording of reasons and issues below is part of the results.


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN where the type has it."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _to_rows(one_row: DataFrame, names: Sequence[str], fields: Sequence[str], groups=()):
    """Turn columns ``<name>__<field>`` into one row per name."""
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("feature"),
            *(F.col(f"{name}__{field}").alias(field) for field in fields),
        )
        for i, name in enumerate(names)
    ]
    return one_row.select(*groups, F.inline(F.array(*cells)))


def missing_fractions(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of missing values per column, all columns in one pass."""
    names = list(columns or df.columns)
    one = df.agg(
        F.count("*").alias("n_rows"),
        *(F.avg(is_missing(df, n).cast("int")).alias(f"{n}__missing_fraction") for n in names),
    )
    rows = _to_rows(one, names, ["missing_fraction"], groups=["n_rows"])
    return rows.select(F.col("feature").alias("column_name"), "n_rows", "missing_fraction")


def _checked(df: DataFrame, settings: Settings, columns: Sequence[str] | None) -> DataFrame:
    """One row: ``n_rows_checked`` and the array ``issues``; a single pass."""
    names = list(columns or df.columns)
    signed = [n for n in settings.non_negative_columns if n in names]
    limit = settings.max_missing_fraction
    one = df.agg(
        F.count("*").alias("n_rows_checked"),
        *(F.avg(is_missing(df, n).cast("int")).alias(f"missing__{n}") for n in names),
        *(F.count_if(F.col(n) < 0).alias(f"negative__{n}") for n in signed),
    )

    def issue(name: str, kind: str, value: Column, over: Column, message: Column) -> Column:
        return F.when(
            over,
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("kind"),
                value.cast("double").alias("value"),
                message.alias("message"),
            ),
        )

    found = []
    for n in names:
        fraction = F.col(f"missing__{n}")
        text = f"Column '{n}' has %.2f%% missing values (> {limit * 100:.0f}%% threshold)"
        percent = F.round(fraction * 100, 2)
        found.append(
            issue(n, "missing", fraction, fraction > limit, F.format_string(text, percent))
        )
    for n in signed:
        bad = F.col(f"negative__{n}")
        text = f"Column '{n}' has %d out-of-range (negative) values"
        found.append(issue(n, "negative", bad, bad > 0, F.format_string(text, bad)))
    return one.select("n_rows_checked", F.array_compact(F.array(*found)).alias("issues"))


def quality_issues(
    df: DataFrame, settings: Settings = Settings(), columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per issue: too many missing values, or negative numbers."""
    return _checked(df, settings, columns).select(F.inline("issues"))


def quality_report(
    df: DataFrame, settings: Settings = Settings(), columns: Sequence[str] | None = None
) -> DataFrame:
    """One row: rows checked, issue messages and whether the check passed."""
    return _checked(df, settings, columns).select(
        "n_rows_checked",
        F.col("issues.message").alias("issues"),
        (F.size("issues") == 0).alias("passed"),
    )


def feature_moments(
    df: DataFrame, features: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """Mean and sample standard deviation per feature (and group); one pass."""
    aggregates = []
    for name in features:
        value = F.nanvl(F.col(name).cast("double"), F.lit(None))
        aggregates.append(F.avg(value).alias(f"{name}__mean"))
        aggregates.append(F.stddev_samp(value).alias(f"{name}__std"))
    wide = df.groupBy(*groups).agg(*aggregates) if groups else df.agg(*aggregates)
    return _to_rows(wide, features, ["mean", "std"], groups)


def drift_report(
    train: DataFrame,
    recent: DataFrame,
    settings: Settings = Settings(),
    groups: Sequence[str] = (),
) -> DataFrame:
    """:func:`drift_from` the moments of the training rows."""
    return drift_from(
        feature_moments(train, list(settings.drift_features)), recent, settings, groups
    )


def drift_from(
    moments: DataFrame,
    recent: DataFrame,
    settings: Settings = Settings(),
    groups: Sequence[str] = (),
) -> DataFrame:
    """Mean drift of ``recent`` against training ``moments`` in training deviations.

    One row per feature, and per group of the recent rows if ``groups`` are
    given. No spread scores 0; an undefined score is null and never flagged.
    The flag looks at the unrounded score.
    """
    features = list(settings.drift_features)
    now = feature_moments(recent, features, groups).withColumnRenamed("mean", "recent_mean")
    return flag_drift(moments, now, settings, groups)


def flag_drift(
    moments: DataFrame, now: DataFrame, settings: Settings, groups: Sequence[str] = ()
) -> DataFrame:
    """Scores of recent means (feature, recent_mean) against (feature, mean, std)."""
    then = moments.select(
        F.col("feature").alias("_feature"),
        F.col("mean").alias("train_mean"),
        F.col("std").alias("train_std"),
    )
    # One row per configured feature: the size is known, whatever the data.
    joined = now.join(F.broadcast(then), F.col("feature") == F.col("_feature"))
    score = F.when(F.col("train_std") == 0, F.lit(0.0)).otherwise(
        F.abs(F.col("recent_mean") - F.col("train_mean")) / F.nullif("train_std", F.lit(0.0))
    )
    return joined.select(
        *groups,
        "feature",
        F.round("train_mean", 3).alias("train_mean"),
        F.round("recent_mean", 3).alias("recent_mean"),
        F.round(score, 3).alias("drift_zscore"),
        F.coalesce(score > settings.drift_threshold, F.lit(False)).alias("flagged"),
    )


def drift_summary(report: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The largest score (0 if none is defined) and whether any feature is flagged."""
    aggregates = [
        F.coalesce(F.max("drift_zscore"), F.lit(0.0)).alias("max_drift_zscore"),
        F.bool_or("flagged").alias("drift_detected"),
    ]
    return report.groupBy(*groups).agg(*aggregates) if groups else report.agg(*aggregates)
