"""Quality and drift of recent rows, and the signals for retraining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.promotion import retrain_decisions
from millrace.operators.quality import drift_report, drift_summary, quality_report
from millrace.operators.ranks import latest_batch, recent_rows
from millrace.settings import Settings
from millrace.sources.tables import latest, read_or_empty, write_batch

DRIFT_REPORT = (
    "feature string, train_mean double, recent_mean double, drift_zscore double, "
    "flagged boolean, batch_id long"
)


def monitor(
    table: DataFrame, order: list[str], settings: Settings = Settings(), batch: str | None = None
):
    """(quality, drift) of the last rows of a table, or of its latest ``batch``, against the whole."""
    columns = [c for c in table.columns if c not in order]
    recent = latest_batch(table, batch) if batch else recent_rows(table, order, settings.recent_rows)
    quality = quality_report(recent, settings, columns)
    return quality, drift_report(table, recent, settings)


def drift_by_batch(table: DataFrame, batch: str, settings: Settings = Settings()) -> DataFrame:
    """Drift of every ingested batch against the whole table in one job."""
    return drift_report(table, table, settings, groups=[batch])


def write_reports(quality: DataFrame, drift: DataFrame, path: str, run: int) -> None:
    """Append the reports of one run; a repeated run replaces its own."""
    write_batch(quality.coalesce(1), f"{path}/quality", run)
    write_batch(drift.coalesce(1), f"{path}/drift", run)


def latest_drift(spark: SparkSession, path: str) -> DataFrame:
    """Largest drift of the newest run; no rows before the first report."""
    runs = read_or_empty(spark, f"{path}/drift", DRIFT_REPORT)
    return latest(drift_summary(runs, ["batch_id"]), "batch_id")


def retrain_check(
    days_since_last_training: int,
    recent_labeled_auc: float | None,
    production: DataFrame,
    drift: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """One decision row from the production model and the latest drift.

    Both tables hold one row or none; what is absent reads 0.
    """
    given = production.sparkSession.createDataFrame(
        [(days_since_last_training, recent_labeled_auc)],
        "days_since_last_training int, recent_labeled_auc double",
    )
    auc = production.agg(F.max("test_metrics.roc_auc")).scalar()
    score = drift.agg(F.max("max_drift_zscore")).scalar()
    return retrain_decisions(
        given.withColumns({"production_auc": auc, "drift_zscore": score}), settings
    )


def log_checks(decisions: DataFrame, path: str) -> None:
    """Append retraining decisions with their signals, reasons and the time of the check."""
    decisions.withColumn("checked_at", F.current_timestamp()).write.mode("append").parquet(path)
