"""Exact model metrics and latency summaries for any number of groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import flag
from millrace.operators.aggregates import Measure, one_phase
from millrace.operators.running import running_totals, same_keys


def _per_group(df: DataFrame, groups: Sequence[str], *aggregates) -> DataFrame:
    return df.groupBy(*groups).agg(*aggregates) if groups else df.agg(*aggregates)


def accuracy(
    df: DataFrame, prediction: str, label: str, groups: Sequence[str] = ()
) -> DataFrame:
    """Share of rows where the prediction equals the label, and their number."""
    hit = F.col(prediction).eqNullSafe(F.col(label)).cast("int")
    return _per_group(df, groups, F.avg(hit).alias("accuracy"), F.count("*").alias("n_samples"))


def roc_auc(df: DataFrame, score: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve per group, ties counted half.

    Rows collapse to (group, score, positives, negatives); the area is the
    share of (positive, negative) pairs in the right order. Nothing is sampled
    or binned: pairs are counted in doubles, exact up to 2**53 half-pairs and
    rounded in the last digits beyond. A group with one class only gets null.
    Rows lacking score or label have no part in it.
    """
    scored = df.select(
        *groups,
        F.nanvl(F.col(score).cast("double"), F.lit(None)).alias("_score"),
        (F.col(label) == 1).cast("int").alias("_positive"),
    ).where("_score is not null and _positive is not null")
    positive = F.col("_positive")
    run = running_totals(scored, groups, "_score", {"pos": positive, "neg": 1 - positive})
    half_pairs = F.col("pos").cast("double") * (2 * F.col("neg_before") + F.col("neg"))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    area = F.sum(half_pairs) / F.nullif(2 * pairs, F.lit(0.0))
    return _per_group(
        run,
        groups,
        area.alias("roc_auc"),
        F.sum("pos").alias("n_positive"),
        F.sum("neg").alias("n_negative"),
    )


def _micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970, for timestamps with or without a time zone."""
    if not isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.unix_micros(F.col(name))
    # Read the clock fields: a cast would bring in the session's time zone.
    days = F.datediff(F.col(name), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = days * 86_400 + F.hour(name) * 3_600 + F.minute(name) * 60
    fraction = F.extract(F.lit("SECOND"), F.col(name)) * 1_000_000
    return seconds * 1_000_000 + fraction.cast("long")


def latency_summary(
    df: DataFrame,
    duration_ms: str,
    failed: str,
    started: str,
    groups: Sequence[str] = (),
    scale: int | None = None,
) -> DataFrame:
    """Requests, errors, throughput and latency statistics per group; exact.

    Failed requests count as requests and errors only. The 95th percentile is
    the sorted value at index floor(0.95 n), capped at the last one; the median
    interpolates. Throughput is requests per second from the first start to
    the last end. Where every request failed the latencies are null.
    """
    ok = df.where(~F.coalesce(F.col(failed), F.lit(False)))
    start_us = _micros(df, started)
    end_us = start_us + F.round(F.col(duration_ms) * 1000).cast("long")
    base = df.select(
        *groups,
        flag(F.col(failed)).alias("_failed"),
        F.when(~F.coalesce(F.col(failed), F.lit(False)), F.col(duration_ms)).alias("_ok_ms"),
        start_us.alias("_start"),
        end_us.alias("_end"),
    )
    summary = _per_group(
        base,
        groups,
        F.count("*").alias("n_requests"),
        F.sum("_failed").alias("n_errors"),
        one_phase("mean_ms", Measure("avg", "_ok_ms", scale)),
        F.max("_ok_ms").alias("max_ms"),
        ((F.max("_end") - F.min("_start")) / 1e6).alias("wall_seconds"),
    ).withColumn(
        "requests_per_second", F.col("n_requests") / F.nullif(F.col("wall_seconds"), F.lit(0.0))
    )

    timed = ok.select(*groups, F.col(duration_ms).alias("_ms")).where("_ms is not null")
    run = running_totals(timed, groups, "_ms", {"n": F.lit(1)})

    # A value covers the sorted places [n_before, n_before + n) of n_total.
    total = F.col("n_total")

    def at(place: Column) -> Column:
        covers = (F.col("n_before") <= place) & (place < F.col("n_before") + F.col("n"))
        return F.max(F.when(covers, F.col("_ms")))

    quantiles = _per_group(
        run,
        groups,
        ((at(F.floor((total - 1) / 2)) + at(F.floor(total / 2))) / 2).alias("p50_ms"),
        at(F.least(F.floor(total * 0.95), total - 1)).alias("p95_ms"),
    )
    if groups:
        of_groups = [f"_of_{g}" for g in groups]
        quantiles = quantiles.withColumnsRenamed(dict(zip(groups, of_groups)))
        summary = summary.join(quantiles, same_keys(groups, of_groups), "left")
    else:
        both = quantiles.select(F.struct("p50_ms", "p95_ms")).scalar()
        summary = summary.withColumns({c: both.getField(c) for c in ("p50_ms", "p95_ms")})
    return summary.select(
        *groups,
        "n_requests",
        "n_errors",
        "wall_seconds",
        "requests_per_second",
        "mean_ms",
        "p50_ms",
        "p95_ms",
        "max_ms",
    )
