"""Run a job: ``spark-submit ... -m millrace JOB ...`` or ``python -m millrace JOB ...``.

    telemetry PINGS OUTPUT           summary per vehicle model, busiest vehicles
    prepare RAW OUTPUT               clean raw customers, split 90/10 by position into
                                     OUTPUT/part=initial and OUTPUT/part=incoming
    compact TABLE [--least-deltas N] write buckets that hold deltas anew
    ingest TABLE INCOMING [--seed DIR] [--quarantine DIR] [--archive DIR] [--files-per-batch N]
    train TABLE MODELS               first training
    retrain TABLE MODELS             train again, replace production if better
    monitor TABLE REPORTS [--latest-batch]  quality and drift of the latest rows or batch
    retrain-check MODELS REPORTS [--days N] [--recent-auc X]
    score TABLE MODELS OUTPUT        scores of valid rows, the others apart
    ingest-stream TABLE INCOMING CHECKPOINT         ingest what is new or changed in a folder
    score-stream RECORDS MODELS OUTPUT CHECKPOINT   score records that arrive as Parquet files
    monitor-stream RECORDS MODELS OUTPUT CHECKPOINT reports per arriving batch against the training rows

Every job takes --settings FILE, a JSON file of fields of Settings. The streaming jobs take
what is there and end; --every SECONDS keeps them running.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from millrace.functions.cleaning import clean_customers
from millrace.operators.layout import overwrite_parquet, write_split
from millrace.operators.ranks import positional_split
from millrace.operators.validation import check_records, quarantined
from millrace.plans import monitoring, telemetry, training
from millrace.plans.ingestion import INGEST_ORDER, Ingestion
from millrace.schemas import CUSTOMER_COLUMNS
from millrace.sources.files import (
    POSITION,
    list_csv,
    read_raw_customers,
    read_telemetry_csv,
)
from millrace.sources.tables import BucketedTable
from millrace.settings import Settings
from millrace.streaming.ingest import ingest_folder, start_ingest
from millrace.streaming.monitoring import start_monitoring
from millrace.streaming.scoring import incoming_records, start_quarantine, start_scoring


def run_telemetry(spark: SparkSession, args) -> None:
    pings = read_telemetry_csv(spark, args.pings)
    overwrite_parquet(telemetry.model_summary(pings), f"{args.output}/model_summary")
    averages = telemetry.vehicle_averages(pings, ["vehicle_id", "timestamp"])
    overwrite_parquet(averages, f"{args.output}/vehicle_averages")
    spark.read.parquet(f"{args.output}/model_summary").orderBy("vehicle_model").show(truncate=False)
    written = spark.read.parquet(f"{args.output}/vehicle_averages")
    telemetry.busiest_vehicles(written).show(truncate=False)


def run_prepare(spark: SparkSession, args) -> None:
    cleaned = clean_customers(read_raw_customers(spark, args.raw), POSITION)
    split = positional_split(cleaned, list(POSITION), 0.9)
    write_split(split.select(*CUSTOMER_COLUMNS, "part"), args.output)


def run_ingest(spark: SparkSession, args) -> None:
    ingestion = Ingestion(spark, args.table, args.settings, quarantine=args.quarantine)
    if args.seed and ingestion.table.state().version is None:
        ingestion.seed(list_csv(spark, args.seed))
    ingest_folder(ingestion, args.incoming, args.files_per_batch, args.archive)
    ingestion.table.ingestion_log().show(truncate=False)


def run_compact(spark: SparkSession, args) -> None:
    print(f"{BucketedTable(spark, args.table).compact(args.least_deltas)} buckets written anew")


def _customers(spark: SparkSession, path: str):
    return BucketedTable(spark, path).read()


def run_train(spark: SparkSession, args) -> None:
    store = training.ModelStore(spark, args.models)
    print(training.train(_customers(spark, args.table), store, args.settings).reason)


def run_retrain(spark: SparkSession, args) -> None:
    store = training.ModelStore(spark, args.models)
    print(training.retrain(_customers(spark, args.table), store, args.settings).reason)


def run_monitor(spark: SparkSession, args) -> None:
    version = BucketedTable(spark, args.table).state().version
    quality, drift = monitoring.monitor(
        _customers(spark, args.table), INGEST_ORDER, args.settings, "batch_id" if args.latest_batch else None
    )
    monitoring.write_reports(quality, drift, args.reports, version)
    monitoring.latest_drift(spark, args.reports).show()


def run_retrain_check(spark: SparkSession, args) -> None:
    store = training.ModelStore(spark, args.models)
    production = training.promotion.production_models(store.registry())
    drift = monitoring.latest_drift(spark, args.reports)
    checked = monitoring.retrain_check(args.days, args.recent_auc, production, drift, args.settings)
    monitoring.log_checks(checked, f"{args.models}/retrain_checks")
    checked.show(truncate=False)


def run_score(spark: SparkSession, args) -> None:
    store = training.ModelStore(spark, args.models)
    production = _production(store)
    customers = _customers(spark, args.table)
    model = store.load(production)
    scores = training.score(model, customers, production.model_version, production.model_type)
    overwrite_parquet(scores, f"{args.output}/scores")
    overwrite_parquet(quarantined(check_records(customers)), f"{args.output}/invalid")


def _until_done(query) -> None:
    query.awaitTermination()


def run_ingest_stream(spark: SparkSession, args) -> None:
    ingestion = Ingestion(spark, args.table, args.settings)
    _until_done(start_ingest(ingestion, args.incoming, args.checkpoint, trigger=args.trigger))


def _production(store: training.ModelStore):
    production = store.production()
    if production is None:
        raise SystemExit("no model in production; run train first")
    return production


def run_score_stream(spark: SparkSession, args) -> None:
    store = training.ModelStore(spark, args.models)
    row = _production(store)
    records = incoming_records(spark, args.records)
    scores = start_scoring(
        store.load(row), records, f"{args.output}/scores", f"{args.checkpoint}/scores",
        row.model_version, row.model_type, args.trigger,
    )
    bad = start_quarantine(records, f"{args.output}/invalid", f"{args.checkpoint}/invalid", args.trigger)
    for query in (scores, bad):
        _until_done(query)


def run_monitor_stream(spark: SparkSession, args) -> None:
    store = training.ModelStore(spark, args.models)
    train = store.profile(_production(store))
    records = incoming_records(spark, args.records)
    _until_done(start_monitoring(records, train, args.output, args.checkpoint, args.settings, args.trigger))


JOBS = {
    "telemetry": (run_telemetry, ["pings", "output"]),
    "prepare": (run_prepare, ["raw", "output"]),
    "ingest": (run_ingest, ["table", "incoming"]),
    "compact": (run_compact, ["table"]),
    "train": (run_train, ["table", "models"]),
    "retrain": (run_retrain, ["table", "models"]),
    "monitor": (run_monitor, ["table", "reports"]),
    "retrain-check": (run_retrain_check, ["models", "reports"]),
    "score": (run_score, ["table", "models", "output"]),
    "ingest-stream": (run_ingest_stream, ["table", "incoming", "checkpoint"]),
    "score-stream": (run_score_stream, ["records", "models", "output", "checkpoint"]),
    "monitor-stream": (run_monitor_stream, ["records", "models", "output", "checkpoint"]),
}


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        "millrace", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, (_, positional) in JOBS.items():
        job = jobs.add_parser(name)
        for argument in positional:
            job.add_argument(argument)
        job.add_argument("--settings", type=Settings.read, default=Settings())
        if name.endswith("-stream"):
            job.add_argument("--every", type=float)
        if name == "ingest":
            job.add_argument("--seed")
            job.add_argument("--quarantine")
            job.add_argument("--archive")
            job.add_argument("--files-per-batch", type=int, default=1000)
        if name == "monitor":
            job.add_argument("--latest-batch", action="store_true")
        if name == "compact":
            job.add_argument("--least-deltas", type=int, default=1)
        if name == "retrain-check":
            job.add_argument("--days", type=int, default=0)
            job.add_argument("--recent-auc", type=float)
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    args = parse(arguments)
    every = getattr(args, "every", None)
    args.trigger = {"processingTime": f"{every} seconds"} if every else None
    spark = SparkSession.builder.appName(f"millrace {args.job}").getOrCreate()
    JOBS[args.job][0](spark, args)


if __name__ == "__main__":
    main()
