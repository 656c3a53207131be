"""Score customer records as they arrive, with the batch scoring function."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace import schemas
from millrace.operators.validation import check_records, quarantined
from millrace.plans.training import score
from millrace.streaming.ingest import ANY_AGE


def incoming_records(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of customer records from Parquet files."""
    reader = spark.readStream.schema(schemas.CUSTOMER).option("maxFileAge", ANY_AGE)
    return reader.parquet(folder)


def start_scoring(
    model: PipelineModel,
    records: DataFrame,
    output: str,
    checkpoint: str,
    model_version: str,
    model_type: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the scores of valid records to a table."""
    return (
        score(model, records, model_version, model_type)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(output)
    )


def start_quarantine(
    records: DataFrame, output: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append records outside the domain, with the fields at fault, to a table."""
    return (
        quarantined(check_records(records))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(output)
    )
