"""Quality and drift reports for every arriving batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.profiles import drift_from_profiles, issues, profile
from millrace.settings import Settings
from millrace.sources.tables import write_batch


def start_monitoring(
    records: DataFrame,
    train: DataFrame,
    output: str,
    checkpoint: str,
    settings: Settings = Settings(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write a ``profile`` per batch below ``output``, and its ``drift`` and ``quality`` rows.

    ``train`` are the training rows, or a profile of them (such as a model's or the merged
    ones of batches), which saves reading them. A batch is read once; both reports come
    from its profile. A batch delivered twice overwrites its own folders.
    """
    if "m2" not in train.columns:
        train = profile(train, list(settings.drift_features))
    # A row per column.
    train = train.sparkSession.createDataFrame(train.collect(), train.schema)

    def report(batch: DataFrame, epoch: int) -> None:
        write_batch(profile(batch).coalesce(1), f"{output}/profile", epoch)
        own = batch.sparkSession.read.parquet(f"{output}/profile/batch_id={epoch}")
        write_batch(drift_from_profiles(train, own, settings).coalesce(1), f"{output}/drift", epoch)
        write_batch(issues(own, settings).coalesce(1), f"{output}/quality", epoch)

    return (
        records.writeStream.foreachBatch(report)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
