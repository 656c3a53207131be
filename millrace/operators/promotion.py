"""Promotion guardrail, model registry and retraining triggers, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.running import same_keys
from millrace.settings import Settings

METRICS = T.StructType(
    [
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("roc_auc", T.DoubleType()),
        T.StructField("n_samples", T.LongType()),
    ]
)
REGISTRY = T.StructType(
    [
        T.StructField("sequence", T.LongType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("promoted", T.BooleanType()),
        T.StructField("reason", T.StringType()),
        T.StructField("trained_at", T.TimestampType()),
        T.StructField("feature_columns", T.ArrayType(T.StringType())),
        T.StructField("test_metrics", METRICS),
        T.StructField("model_path", T.StringType()),
    ]
)


# The wording of reasons and issues below is part of the results.


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("undefined"))


def _decide(
    candidate: Column, reference: Column, settings: Settings, split: str, names: dict
) -> tuple[Column, Column]:
    """Guardrail in doubles: candidate at the floor and not much below the reference."""
    floor, margin = F.lit(settings.min_roc_auc), F.lit(settings.max_regression)
    meets_floor = F.coalesce(candidate >= floor, F.lit(False))
    close_enough = F.coalesce(reference - candidate <= margin, F.lit(False))
    promoted = meets_floor & close_enough
    subject = F.concat(F.lit(f"{names['subject']} {split} ROC AUC "), _text(candidate))
    failures = F.concat_ws(
        "; ",
        F.when(~meets_floor, F.concat(subject, F.lit(" < floor "), _text(floor))),
        F.when(
            ~close_enough,
            F.concat(
                subject,
                F.lit(" regresses more than "),
                _text(margin),
                F.lit(f" vs {names['reference']} "),
                _text(reference),
            ),
        ),
    )
    reason = F.when(
        promoted,
        F.concat(
            F.lit(f"{names['won']}: {split} ROC AUC "),
            _text(candidate),
            F.lit(" >= "),
            _text(floor),
            F.lit(" and within "),
            _text(margin),
            F.lit(f" of {names['reference']} ("),
            _text(reference),
            F.lit(")."),
        ),
    ).otherwise(F.concat(F.lit(f"{names['lost']}: "), failures))
    return promoted, reason


def candidate_vs_baseline(
    candidate: Column, baseline: Column, settings: Settings = Settings(), split: str = "val"
) -> tuple[Column, Column]:
    """(promoted, reason) columns for a candidate's AUC against the baseline's."""
    return _decide(
        candidate,
        baseline,
        settings,
        split,
        {
            "subject": "candidate",
            "reference": "baseline",
            "won": "Promoted candidate",
            "lost": "Kept baseline",
        },
    )


def challenger_vs_production(
    challenger: Column,
    production: Column,
    settings: Settings = Settings(),
    split: str = "test",
    deployed: Column | None = None,
) -> tuple[Column, Column]:
    """(promoted, reason) for a retrained model; nothing in production lets it in unchecked.

    ``deployed`` says whether there is a production model. A production model
    whose AUC is undefined stays, as nothing can be compared with it.
    """
    promoted, reason = _decide(
        challenger,
        production,
        settings,
        split,
        {
            "subject": "retrained model's",
            "reference": "current production model",
            "won": "Promoted retrained model",
            "lost": "Kept current production model",
        },
    )
    vacant = production.isNull() if deployed is None else ~F.coalesce(deployed, F.lit(False))
    return (
        F.when(vacant, True).otherwise(promoted),
        F.when(
            vacant, "No model currently in production; deploying retrained model."
        ).otherwise(reason),
    )


def decide_segments(
    metrics: DataFrame, incumbents: DataFrame, segment: Sequence[str], settings: Settings
) -> DataFrame:
    """Pick and compare a model for every segment at once.

    ``metrics``: segment, baseline_val_auc, candidate_val_auc,
    baseline_test_auc, candidate_test_auc. ``incumbents``: segment,
    production_auc; a segment without a row has nothing deployed.
    """
    inner, inner_reason = candidate_vs_baseline(
        F.col("candidate_val_auc"), F.col("baseline_val_auc"), settings
    )
    picked = metrics.withColumns(
        {"candidate_promoted": inner, "selection_reason": inner_reason}
    ).withColumns(
        {
            "model_type": F.when(
                F.col("candidate_promoted"), settings.candidate_model
            ).otherwise(settings.baseline_model),
            "new_test_auc": F.when(
                F.col("candidate_promoted"), F.col("candidate_test_auc")
            ).otherwise(F.col("baseline_test_auc")),
        }
    )
    of = [f"_of_{s}" for s in segment]
    current = incumbents.select(
        *(F.col(s).alias(o) for s, o in zip(segment, of)),
        "production_auc",
        F.lit(True).alias("_deployed"),
    )
    promoted, reason = challenger_vs_production(
        F.col("new_test_auc"), F.col("production_auc"), settings, deployed=F.col("_deployed")
    )
    return (
        picked.join(current, same_keys(segment, of), "left")
        .withColumns({"promoted": promoted, "promotion_reason": reason})
        .drop(*of, "_deployed")
    )


def production_models(registry: DataFrame, segment: Sequence[str] = ()) -> DataFrame:
    """The deployed model (per segment): the latest promoted attempt."""
    promoted = registry.where("promoted")
    newest = F.max_by(F.struct(*registry.columns), F.col("sequence")).alias("r")
    top = promoted.groupBy(*segment).agg(newest) if segment else promoted.agg(newest)
    return top.where("r is not null").select("r.*")


def with_status(registry: DataFrame, segment: Sequence[str] = ()) -> DataFrame:
    """Every attempt as production, archived or rejected.

    The newest promoted sequence per segment is joined on rather than taken in
    a window, so a segment with very many attempts stays spread over tasks.
    """
    newest = F.max("sequence").alias("_newest")
    promoted = registry.where("promoted")
    of = [f"_of_{s}" for s in segment]
    if segment:
        tops = promoted.groupBy(*(F.col(s).alias(o) for s, o in zip(segment, of))).agg(newest)
        joined = registry.join(tops, same_keys(segment, of), "left").drop(*of)
    else:
        joined = registry.withColumn("_newest", promoted.agg(newest).scalar())
    status = (
        F.when(~F.col("promoted"), "rejected")
        .when(F.col("sequence") == F.col("_newest"), "production")
        .otherwise("archived")
    )
    return joined.withColumn("status", status).drop("_newest")


def retrain_decisions(signals: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Whether to retrain, and every reason that fired: age, AUC drop, drift.

    ``signals``: days_since_last_training, recent_labeled_auc, production_auc,
    drift_zscore. No labelled feedback (null) skips the AUC rule; a missing
    report reads 0.
    """
    days = F.col("days_since_last_training")
    production = F.coalesce(F.col("production_auc"), F.lit(0.0))
    drift = F.coalesce(F.col("drift_zscore"), F.lit(0.0))
    drop = production - F.col("recent_labeled_auc")
    reasons = F.array_compact(
        F.array(
            F.when(
                days >= settings.min_new_days,
                F.concat(
                    days.cast("string"),
                    F.lit(f" days of new data >= minimum {settings.min_new_days}"),
                ),
            ),
            F.when(
                drop >= F.lit(settings.auc_drop),
                F.format_string(
                    f"recent labeled AUC dropped by %.3f >= threshold {settings.auc_drop}",
                    F.round(drop, 3),
                ),
            ),
            F.when(
                drift >= F.lit(settings.drift_trigger),
                F.format_string(
                    f"drift z-score %.2f >= threshold {settings.drift_trigger}",
                    F.round(drift, 2),
                ),
            ),
        )
    )
    return signals.withColumns(
        {"production_auc": production, "drift_zscore": drift, "triggered_by": reasons}
    ).withColumn("should_retrain", F.size("triggered_by") > 0)
