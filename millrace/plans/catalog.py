"""Named queries over the shared tables, one per operator or job.

Each takes (spark, folder) and returns a DataFrame over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.cleaning import clean_customers
from millrace.functions.features import engineer_features, to_model_matrix
from millrace.operators import (
    aggregates,
    asof,
    evaluation,
    hot_keys,
    layout,
    merge,
    promotion,
    quality,
    ranks,
)
from millrace.operators.profiles import drift_from_profiles as profile_drift
from millrace.operators.profiles import merged, profile
from millrace.operators.validation import check_records
from millrace.plans import monitoring, segments, telemetry, training, views
from millrace.plans.ingestion import Ingestion, required_columns
from millrace.session import scratch_path
from millrace.settings import Settings
from millrace.sources.files import (
    list_csv,
    open_headers,
    read_csv_by_name,
    read_raw_customers,
    read_telemetry_csv,
    split_by_header,
)
from millrace.sources.tables import BucketedTable, write_batch
from millrace.sources.commits import Folder
from millrace.streaming.ingest import ingest_folder, start_ingest
from millrace.streaming.monitoring import start_monitoring
from millrace.streaming.scoring import incoming_records, start_quarantine, start_scoring

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- telemetry -------------------------------------------------------------


@query
def telemetry_model_summary(spark, folder):
    return telemetry.model_summary(views.telemetry(spark, folder), scale=2)


@query
def telemetry_from_csv(spark, folder):
    path = scratch_path(spark, "telemetry-csv")
    pings = views.telemetry(spark, folder)
    pings.select(
        "vehicle_id",
        "vehicle_model",
        F.col("event_time").cast("timestamp").alias("timestamp"),
        "engine_temp_c",
        "speed_kmph",
        F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"),
        F.lit(0.9).alias("battery_efficiency"),
        "miles_driven",
    ).write.option("header", True).csv(path)
    return telemetry.model_summary(read_telemetry_csv(spark, path), scale=2)


@query
def telemetry_skew_profile(spark, folder):
    return aggregates.skew_profile(
        telemetry.readings(views.telemetry(spark, folder)), ["vehicle_id"]
    )


@query
def telemetry_plain_avg(spark, folder):
    return telemetry.vehicle_averages(
        views.telemetry(spark, folder), ["event_id"], scale=2, salted=False
    )


@query
def telemetry_salted_avg(spark, folder):
    return telemetry.vehicle_averages(views.telemetry(spark, folder), ["event_id"], scale=2)


@query
def telemetry_selective_salt(spark, folder):
    """Vehicle averages in which only the hot vehicles, named by a sketch per day, are salted."""
    pings = telemetry.readings(views.telemetry(spark, folder), "event_id", "event_time")
    days = hot_keys.hot_key_state(
        pings.withColumn("day", F.to_date("event_time")), telemetry.VEHICLE, ["day"]
    )
    return hot_keys.selectively_salted_agg(
        pings, telemetry.VEHICLE, telemetry.averages(scale=2), ["event_id"], states=days
    )


@query
def telemetry_top_vehicles(spark, folder):
    return telemetry.busiest_vehicles(telemetry_salted_avg(spark, folder))


@query
def telemetry_hash_layout(spark, folder):
    return layout.hash_layout(telemetry_salted_avg(spark, folder), 4, "vehicle_model")


@query
def telemetry_range_layout(spark, folder):
    path = scratch_path(spark, "telemetry-by-day")
    layout.write_by_day(views.telemetry(spark, folder), path, "event_time")
    return spark.read.parquet(path)


@query
def telemetry_iterated(spark, folder):
    return telemetry.adjusted_readings(views.telemetry(spark, folder))


@query
def telemetry_iterated_checkpointed(spark, folder):
    return telemetry.adjusted_readings_iterated(views.telemetry(spark, folder))


# --- customers: cleaning, features, validation -----------------------------


@query
def customer_clean(spark, folder):
    return views.customers(spark, folder).select(*schemas.CUSTOMER_COLUMNS)


@query
def customer_clean_from_csv(spark, folder):
    path = scratch_path(spark, "raw-customers-csv")
    raw = views.raw_customers(spark, folder).select(*schemas.RENAMES)
    raw.write.option("header", True).option("ignoreTrailingWhiteSpace", False).option(
        "ignoreLeadingWhiteSpace", False
    ).csv(path)
    return clean_customers(read_raw_customers(spark, path))


@query
def customer_churn_rate(spark, folder):
    return aggregates.rate(views.customers(spark, folder), "churn", "churn_rate")


@query
def customer_features(spark, folder):
    return engineer_features(customer_clean(spark, folder))


@query
def customer_model_matrix(spark, folder):
    return to_model_matrix(views.customers(spark, folder), ("customer_id",))


@query
def customer_partial_input(spark, folder):
    partial = views.customers(spark, folder).select("customer_id", "tenure_months")
    return to_model_matrix(partial, ("customer_id",))


def faulty_records(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with faults that depend on nation and balance."""
    nation = F.col("c_nationkey")

    def fault(name: str, when, value):
        return F.when(when, F.lit(value)).otherwise(F.col(name))

    customers = views.customers(spark, folder)
    return customers.withColumns(
        {
            "tenure_months": F.when(nation == 3, -1)
            .when(nation == 4, 101)
            .otherwise(F.col("tenure_months")),
            "monthly_charges": F.when(F.col("c_acctbal") < 0, -F.col("monthly_charges")).otherwise(
                F.col("monthly_charges")
            ),
            "total_charges": fault("total_charges", nation.isin(11, 12), None),
            "contract_type": fault("contract_type", nation == 7, "not_a_real_contract"),
            "partner": fault("partner", nation == 9, 2),
            "tech_support": fault("tech_support", nation == 13, None),
        }
    ).select(*schemas.CUSTOMER_COLUMNS)


@query
def record_validation(spark, folder):
    checked = check_records(faulty_records(spark, folder))
    return checked.select(
        "customer_id", F.concat_ws(",", "failed_fields").alias("failed_fields"), "is_valid"
    )


# --- splits ----------------------------------------------------------------


@query
def positional_split(spark, folder):
    customers = views.customers(spark, folder).select("customer_id", "c_custkey")
    return ranks.positional_split(customers, ["c_custkey"], 0.9).drop("c_custkey")


@query
def positional_split_text(spark, folder):
    """Order by a long path that a third of all rows or more share, then by number."""
    customers = views.customers(spark, folder).select(
        "customer_id",
        "c_custkey",
        F.concat(
            F.lit("store:/exports/of/customers/by/part-0000"),
            F.when(F.col("c_custkey") % 3 == 0, 1).otherwise(F.col("c_custkey") % 5),
            F.lit("-of-many.csv"),
        ).alias("path"),
    )
    return ranks.positional_split(customers, ["path", "c_custkey"], 0.9).drop("c_custkey")


@query
def split_tables(spark, folder):
    path = scratch_path(spark, "split")
    customers = views.customers(spark, folder).select(*schemas.CUSTOMER_COLUMNS, "c_custkey")
    split = ranks.positional_split(customers, ["c_custkey"], 0.9).drop("c_custkey")
    layout.write_split(split, path, form="parquet")
    return spark.read.parquet(path).select(*schemas.CUSTOMER_COLUMNS, "part")


def _portable_hash(name: str):
    """A hash every SQL engine has: the leading 60 bits of an MD5."""
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


@query
def stratified_split(spark, folder):
    rows = views.customers(spark, folder).select("customer_id", "churn")
    return ranks.stratified_split(
        rows, "churn", "customer_id", order=_portable_hash("customer_id")
    )


@query
def stratified_split_sizes(spark, folder):
    rows = views.customers(spark, folder).select("customer_id", "churn")
    split = ranks.stratified_split(rows, "churn", "customer_id")
    return split.groupBy("churn", "split").agg(F.count("*").alias("n_rows"))


# --- merge and ingestion ---------------------------------------------------


def customer_batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(initial rows, incoming rows, corrections of customers in debt)."""
    columns = [*schemas.CUSTOMER_COLUMNS, "c_custkey", "c_nationkey", "c_acctbal"]
    customers = views.customers(spark, folder).select(*columns)
    split = ranks.positional_split(customers, ["c_custkey"], 0.9)
    corrected = customers.where("c_acctbal < 0").withColumn(
        "monthly_charges", F.col("monthly_charges") + 1
    )
    return (
        split.where("part = 'initial'").drop("part"),
        split.where("part = 'incoming'").drop("part"),
        corrected,
    )


def _merged(spark, folder, base_keys_unique: bool) -> DataFrame:
    initial, incoming, corrected = customer_batches(spark, folder)
    twice = corrected.where("c_nationkey < 5").withColumn(
        "monthly_charges", F.col("monthly_charges") + 1
    )

    def rows(df: DataFrame, batch: int, place: int) -> DataFrame:
        return df.select(
            *schemas.CUSTOMER_COLUMNS,
            F.lit(batch).alias("batch_id"),
            (F.col("c_custkey") * 3 + place).alias("place"),
        )

    batch = merge.concat(rows(incoming, 1, 0), rows(corrected, 1, 1), rows(twice, 1, 2))
    return merge.merge_latest(
        rows(initial, 0, 0), batch, "customer_id", ["batch_id", "place"], base_keys_unique
    ).select(*schemas.CUSTOMER_COLUMNS, "batch_id")


@query
def merge_latest(spark, folder):
    return _merged(spark, folder, base_keys_unique=False)


@query
def merge_latest_incremental(spark, folder):
    return _merged(spark, folder, base_keys_unique=True)


@query
def concat_batches(spark, folder):
    initial, incoming, _ = customer_batches(spark, folder)
    return merge.concat(
        initial.select("customer_id", "tenure_months", "churn"),
        incoming.select("customer_id", "churn", "c_nationkey"),
    )


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("append").option("header", True).csv(path)
    return path


def _ingested(spark: SparkSession, folder: str) -> Ingestion:
    """Seed with the initial rows, then two streamed rounds, one file misnamed."""
    initial, incoming, corrected = customer_batches(spark, folder)
    root = scratch_path(spark, "ingest")
    columns = schemas.CUSTOMER_COLUMNS
    seed = _write_csv(initial.select(*columns), f"{root}/seed")
    ingestion = Ingestion(spark, f"{root}/table")
    ingestion.seed(list_csv(spark, seed))

    inbox = _write_csv(incoming.select(*columns), f"{root}/inbox")
    ingest_folder(ingestion, inbox)
    # The second round has columns in another order and one file lacking a column.
    _write_csv(corrected.select(*reversed(columns)), inbox)
    renamed = incoming.select(*columns).withColumnRenamed("contract_type", "contract")
    _write_csv(renamed, inbox)
    ingest_folder(ingestion, inbox)
    # Nothing new: a further run changes nothing.
    ingest_folder(ingestion, inbox)
    return ingestion


@query
def stream_ingest(spark, folder):
    table = _ingested(spark, folder).table.read()
    return table.select(*schemas.CUSTOMER_COLUMNS, "batch_id")


@query
def ingestion_log_counts(spark, folder):
    log = _ingested(spark, folder).table.commits()
    return log.groupBy(
        "batch_id", "status", F.concat_ws(",", "missing_columns").alias("missing_columns")
    ).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))


def _named_csv(df: DataFrame, folder: str, name: str) -> None:
    """One file of that very name, in place of any of the same name."""
    spark = df.sparkSession
    place = Folder(spark, folder)
    aside = f"_aside-{name.encode().hex()}"
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(place.at(aside))
    (part,) = [n for n in place.names(aside) if n.endswith(".csv")]
    place.delete(name)
    place.rename(f"{aside}/{part}", name)
    place.delete(aside)


@query
def ingest_odd_names(spark, folder):
    """Files whose names hold brackets, braces, blanks and per cent signs, one misnamed in a column."""
    initial, incoming, corrected = customer_batches(spark, folder)
    columns = schemas.CUSTOMER_COLUMNS
    inbox = scratch_path(spark, "odd names [in] {box} 100%")
    part = F.col("c_custkey") % 3
    _named_csv(initial.where(part == 0).select(*columns), inbox, "b[1].csv")
    _named_csv(initial.where(part == 1).select(*columns), inbox, "b{x,y} 50%.csv")
    _named_csv(initial.where(part == 2).select(*reversed(columns)), inbox, "what? *.csv")
    _named_csv(incoming.select(*columns).withColumnRenamed("churn", "left"), inbox, "c%20d.csv")
    ingestion = Ingestion(spark, f"{scratch_path(spark, 'odd-names')}/table")
    ingest_folder(ingestion, inbox)
    _named_csv(corrected.select(*columns), inbox, "z[a-c]\\d.csv")
    ingest_folder(ingestion, inbox)
    return ingestion.table.read().select(*columns, "batch_id")


@query
def ingest_redelivered(spark, folder):
    """A stream over a folder, restarted between deliveries of new and changed files."""
    initial, incoming, corrected = customer_batches(spark, folder)
    columns = schemas.CUSTOMER_COLUMNS
    root = scratch_path(spark, "redelivered")
    inbox = f"{root}/inbox"
    ingestion = Ingestion(spark, f"{root}/table")

    def deliver(rows: DataFrame, name: str) -> None:
        _named_csv(rows.select(*columns), inbox, name)
        start_ingest(ingestion, inbox, f"{root}/checkpoint").awaitTermination()

    deliver(initial, "a[1].csv")
    deliver(incoming, "b.csv")
    # The first name again with other contents; then nothing new.
    deliver(corrected, "a[1].csv")
    start_ingest(ingestion, inbox, f"{root}/checkpoint").awaitTermination()
    log = ingestion.table.commits().groupBy("batch_id").agg(F.sum("n_rows").alias("rows_of_batch"))
    return ingestion.table.read().select(*columns, "batch_id").join(log, "batch_id")


@query
def header_check(spark, folder):
    """Three exports of all customers: as expected, rearranged with an extra, misnamed."""
    customers = customer_clean(spark, folder)
    columns = schemas.CUSTOMER_COLUMNS
    root = scratch_path(spark, "headers")
    exports = {
        "expected": customers,
        "rearranged": customers.select(*reversed(columns), F.lit("x").alias("note")),
        "misnamed": customers.withColumnsRenamed({"contract_type": "contract", "churn": "left"}),
    }
    folders = [_write_csv(df, f"{root}/{name}") for name, df in exports.items()]
    paths = [path for written in folders for path in list_csv(spark, written)]
    found = open_headers(spark, paths)
    accepted, rejected = split_by_header(found, required_columns(Settings()))
    export = F.regexp_extract("source_file", "([a-z]+)/[^/]*$", 1).alias("export")
    good = read_csv_by_name(spark, accepted, schemas.CUSTOMER).groupBy(export).agg(
        F.lit("ingested").alias("status"),
        F.lit("").alias("missing_columns"),
        F.count("*").alias("n_rows"),
        F.count("contract_type").alias("n_contracts"),
    )
    bad = spark.createDataFrame(
        [(file.path, ",".join(missing)) for file, missing in rejected.items()],
        "source_file string, missing_columns string",
    ).groupBy(export, F.lit("rejected").alias("status"), "missing_columns").agg(
        F.lit(0).cast("long").alias("n_rows"), F.lit(0).cast("long").alias("n_contracts")
    )
    return good.unionByName(bad)


@query
def csv_loose_numbers(spark, folder):
    """Whole numbers as other tools write them: "7.0", " 7 ", "7.5", "abc", blank."""
    path = scratch_path(spark, "loose-numbers")
    tenure = F.col("tenure_months").cast("string")
    kind = F.col("c_custkey") % 5
    views.customers(spark, folder).select(
        "customer_id",
        F.when(kind == 0, F.concat(tenure, F.lit(".0")))
        .when(kind == 1, F.concat(F.lit(" "), tenure, F.lit(" ")))
        .when(kind == 2, F.concat(tenure, F.lit(".5")))
        .when(kind == 3, F.lit("abc"))
        .alias("tenure_months"),
    ).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    found = open_headers(spark, list_csv(spark, path))
    return read_csv_by_name(spark, found, schemas.CUSTOMER).select("customer_id", "tenure_months")


@query
def table_round_trip(spark, folder):
    table = BucketedTable(spark, scratch_path(spark, "round-trip"), "customer_id")
    initial, incoming, _ = customer_batches(spark, folder)
    for number, rows in enumerate((initial, incoming)):
        written = table.replace(rows.select(*schemas.CUSTOMER_COLUMNS))
        log = rows.agg(F.count("*").alias("n_rows")).selectExpr(
            "'rows' AS source_file", "n_rows", "'ingested' AS status"
        )
        table.commit(log, written, number)
    old = table.read(0).withColumn("version", F.lit(0))
    return old.unionByName(table.read().withColumn("version", F.lit(1)))


def _changed_table(spark: SparkSession, folder: str) -> BucketedTable:
    """The initial customers, then the incoming ones and two rounds of corrections as deltas."""
    initial, incoming, corrected = customer_batches(spark, folder)
    raised = F.col("monthly_charges") + 1
    twice = corrected.where("c_nationkey < 5").withColumn("monthly_charges", raised)
    table = BucketedTable(spark, scratch_path(spark, "buckets"), "customer_id", ["batch_id"], buckets=8)
    for batch, rows in enumerate((initial, incoming, corrected, twice)):
        rows = rows.select(*schemas.CUSTOMER_COLUMNS, F.lit(batch).alias("batch_id"))
        table.commit(written=table.upsert(rows), batch_id=batch)
    return table


@query
def table_deltas(spark, folder):
    """A table read with its deltas: as it is and two versions back."""
    table = _changed_table(spark, folder)
    now = table.read().withColumn("version", F.lit(3))
    return now.unionByName(table.read(1).withColumn("version", F.lit(1)))


@query
def table_compaction(spark, folder):
    """The same table after compaction, and a correction after that."""
    table = _changed_table(spark, folder)
    table.compact()
    late = table.read().where("tenure_months = 5").withColumns(
        {"churn": F.lit(1), "batch_id": F.lit(4)}
    )
    table.commit(written=table.upsert(late), batch_id=4)
    return table.read()


@query
def recent_rows(spark, folder):
    customers = views.customers(spark, folder)
    return ranks.recent_rows(customers, ["c_custkey"]).select(*schemas.CUSTOMER_COLUMNS)


# --- monitoring ------------------------------------------------------------


@query
def missing_fractions(spark, folder):
    return quality.missing_fractions(views.telemetry(spark, folder))


@query
def quality_issues(spark, folder):
    return quality.quality_issues(faulty_records(spark, folder))


@query
def quality_report(spark, folder):
    report = quality.quality_report(faulty_records(spark, folder))
    return report.withColumn("issues", F.concat_ws(" | ", "issues"))


@query
def drift_report(spark, folder):
    _, drift = monitoring.monitor(
        views.customers(spark, folder).select(*schemas.CUSTOMER_COLUMNS, "c_custkey"),
        ["c_custkey"],
    )
    return drift


@query
def drift_of_latest_batch(spark, folder):
    """The latest batch (the greatest nation) against all rows."""
    customers = views.customers(spark, folder).select(*schemas.CUSTOMER_COLUMNS, "c_custkey", "c_nationkey")
    _, drift = monitoring.monitor(customers, ["c_nationkey", "c_custkey"], batch="c_nationkey")
    return drift


@query
def drift_from_profiles(spark, folder):
    """The drift of the latest rows from stored profiles of batches, merged; no table is read again."""
    customers = views.customers(spark, folder).select(*schemas.CUSTOMER_COLUMNS, "c_custkey", "c_nationkey")
    path = scratch_path(spark, "profiles")
    features = list(Settings().drift_features)
    for batch in range(3):
        rows = customers.where(F.col("c_nationkey") % 3 == batch)
        write_batch(profile(rows, features).coalesce(1), path, batch)
    recent = profile(ranks.recent_rows(customers, ["c_custkey"]), features)
    return profile_drift(merged(spark.read.parquet(path)), recent)


@query
def drift_by_batch(spark, folder):
    return monitoring.drift_by_batch(views.customers(spark, folder), "c_nationkey")


@query
def drift_by_batch_summary(spark, folder):
    return quality.drift_summary(drift_by_batch(spark, folder), ["c_nationkey"])


@query
def stream_drift(spark, folder):
    initial, incoming, _ = customer_batches(spark, folder)
    root = scratch_path(spark, "stream-drift")
    columns = schemas.CUSTOMER_COLUMNS
    incoming.select(*columns).write.parquet(f"{root}/in")
    start_monitoring(
        incoming_records(spark, f"{root}/in"),
        initial.select(*columns),
        f"{root}/reports",
        f"{root}/checkpoint",
    ).awaitTermination()
    return spark.read.parquet(f"{root}/reports/drift").drop("batch_id")


@query
def stream_quality(spark, folder):
    """Quality rows of a stream of faulty records, its profiles merged over all batches."""
    root = scratch_path(spark, "stream-quality")
    faulty = faulty_records(spark, folder)
    faulty.write.parquet(f"{root}/in")
    clean = views.customers(spark, folder).select(*schemas.CUSTOMER_COLUMNS)
    start_monitoring(
        incoming_records(spark, f"{root}/in"),
        profile(clean, list(Settings().drift_features)),
        f"{root}/reports",
        f"{root}/checkpoint",
    ).awaitTermination()
    return spark.read.parquet(f"{root}/reports/quality").select(
        "n_rows_checked", F.concat_ws(" | ", "issues").alias("issues"), "passed"
    )


# --- evaluation ------------------------------------------------------------


def _quality_scores(spark, folder):
    documents = views.table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    labels = views.table(spark, folder, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id").withColumn(
        "predicted", (F.col("n_chars") > 400).cast("int")
    )


@query
def roc_auc(spark, folder):
    return evaluation.roc_auc(_quality_scores(spark, folder), "n_chars", "quality")


@query
def roc_auc_infinite(spark, folder):
    """Scores that are infinite either way for a seventh of the rows each."""
    kind = F.col("doc_id") % 7
    score = (
        F.when(kind == 0, F.lit(float("inf")))
        .when(kind == 1, F.lit(float("-inf")))
        .otherwise(F.col("n_chars").cast("double"))
    )
    scored = _quality_scores(spark, folder).withColumn("score", score)
    return evaluation.roc_auc(scored, "score", "quality", ["source"])


@query
def roc_auc_by_source(spark, folder):
    return evaluation.roc_auc(_quality_scores(spark, folder), "n_chars", "quality", ["source"])


@query
def accuracy(spark, folder):
    return evaluation.accuracy(_quality_scores(spark, folder), "predicted", "quality")


@query
def accuracy_by_source(spark, folder):
    return evaluation.accuracy(
        _quality_scores(spark, folder), "predicted", "quality", ["source"]
    )


def _requests(spark, folder):
    """Events as requests; errors and everything above 200 ms failed."""
    return views.table(spark, folder, "events").select(
        "event_type",
        "ts",
        "value",
        ((F.col("event_type") == "error") | (F.col("value") > 200)).alias("failed"),
    )


@query
def latency_summary(spark, folder):
    requests = _requests(spark, folder)
    return evaluation.latency_summary(requests, "value", "failed", "ts", ["event_type"], scale=2)


@query
def latency_summary_overall(spark, folder):
    return evaluation.latency_summary(_requests(spark, folder), "value", "failed", "ts", scale=2)


# --- promotion, registry, retraining ---------------------------------------


def _rule_scores(customers: DataFrame) -> DataFrame:
    """Two hand-made churn scores, standing for a baseline and a candidate."""
    contract = F.when(F.col("contract_type").eqNullSafe("month_to_month"), 40).otherwise(0)
    internet = F.when(F.col("internet_service").eqNullSafe("fiber_optic"), 20).otherwise(0)
    return customers.withColumns(
        {
            "baseline_score": -F.col("tenure_months"),
            "candidate_score": contract + internet - F.col("tenure_months"),
        }
    )


@query
def promotion_decisions(spark, folder):
    customers = _rule_scores(views.customers(spark, folder)).select(
        "customer_id", "churn", "c_nationkey", "baseline_score", "candidate_score"
    )
    split = ranks.stratified_split(
        customers, "churn", "customer_id", order=_portable_hash("customer_id")
    )
    # Both scores in one pass over the rows.
    long = split.where("split <> 'train'").select(
        "c_nationkey",
        "split",
        "churn",
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(m).alias("model"), F.col(f"{m}_score").alias("score"))
                    for m in ("baseline", "candidate")
                )
            )
        ),
    )
    areas = evaluation.roc_auc(long, "score", "churn", ["c_nationkey", "model", "split"])
    metrics = areas.groupBy("c_nationkey").agg(
        *(
            F.max(
                F.when(
                    (F.col("model") == m) & (F.col("split") == s), F.round("roc_auc", 4)
                )
            ).alias(f"{m}_{s}_auc")
            for m in ("baseline", "candidate")
            for s in ("val", "test")
        )
    )
    nations = views.table(spark, folder, "nation").where("n_regionkey <> 2")
    deployed = customers.join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"
    )
    incumbents = evaluation.roc_auc(deployed, "candidate_score", "churn", ["c_nationkey"]).select(
        "c_nationkey", F.round("roc_auc", 4).alias("production_auc")
    )
    return promotion.decide_segments(metrics, incumbents, ["c_nationkey"], Settings())


SEGMENT = ["c_nationkey", "c_mktsegment"]


@query
def retrain_decisions(spark, folder):
    customers = _rule_scores(views.customers(spark, folder))
    parts = ranks.positional_split(customers, ["c_custkey"], 0.8)
    recent = parts.where("part = 'incoming'")

    def auc(rows: DataFrame, name: str) -> DataFrame:
        areas = evaluation.roc_auc(rows, "candidate_score", "churn", SEGMENT)
        return areas.select(*SEGMENT, F.round("roc_auc", 4).alias(name))

    drift = quality.drift_summary(
        quality.drift_report(customers, recent, groups=SEGMENT), SEGMENT
    ).select(*SEGMENT, F.col("max_drift_zscore").alias("drift_zscore"))

    orders = views.table(spark, folder, "orders").select("o_custkey", "o_orderdate")
    newest = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("newest"))
    today = orders.agg(F.max("o_orderdate")).scalar()
    ages = (
        customers.join(newest, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy(*SEGMENT)
        .agg(F.max("newest").alias("newest"))
        .select(
            *SEGMENT, F.datediff(today, F.col("newest")).alias("days_since_last_training")
        )
    )
    production = auc(parts.where("part = 'initial'"), "production_auc")
    segments = customers.select(*SEGMENT).distinct()
    signals = reduce(
        lambda a, b: a.join(b, SEGMENT, "left"),
        [segments, ages, production, auc(recent, "recent_labeled_auc"), drift],
    )
    return promotion.retrain_decisions(signals).withColumn(
        "triggered_by", F.concat_ws(" | ", "triggered_by")
    )


def _order_registry(spark, folder):
    """Orders read as training attempts per priority; an F order was promoted."""
    return views.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("sequence"),
        F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("model_version"),
        F.col("o_orderpriority").alias("segment"),
        (F.col("o_orderstatus") == "F").alias("promoted"),
        "o_totalprice",
    )


@query
def registry_current(spark, folder):
    return promotion.production_models(_order_registry(spark, folder), ["segment"])


@query
def registry_status(spark, folder):
    return promotion.with_status(_order_registry(spark, folder), ["segment"]).select(
        "sequence", "segment", "status"
    )


@query
def registry_as_of(spark, folder):
    """For each open order: the model in production for its priority on its date."""
    orders = views.table(spark, folder, "orders")
    promoted = _order_registry(spark, folder).where("promoted").join(
        orders.select(F.col("o_orderkey").alias("sequence"), F.col("o_orderdate").alias("trained_on")), "sequence"
    )
    asked = orders.where("o_orderstatus <> 'F'").select(
        "o_orderkey", F.col("o_orderpriority").alias("segment"), "o_orderdate"
    )
    return asof.as_of(
        asked, "o_orderdate", promoted, "trained_on", ["model_version", "trained_on"], ["segment"], ["sequence"]
    )


@query
def retrain_log(spark, folder):
    """Retraining decisions as stored and read back."""
    path = scratch_path(spark, "retrain-log")
    monitoring.log_checks(retrain_decisions(spark, folder), path)
    return spark.read.parquet(path).drop("checked_at")


# --- models ----------------------------------------------------------------


@query
def segment_models(spark, folder):
    """Churn by a model per nation of one 0/1 column: its probabilities are the groups' shares."""
    customers = views.customers(spark, folder).select("c_nationkey", "senior_citizen", "churn")
    models = segments.fit_segments(customers, ["c_nationkey"], ["senior_citizen"], "churn")
    cells = customers.groupBy("c_nationkey", "senior_citizen").agg(F.count("*").alias("n_rows"))
    scored = segments.score_segments(cells, models, ["c_nationkey"], ["senior_citizen"])
    return scored.withColumn(
        "probability", F.floor(F.col("probability") * 10_000 + F.lit(0.500001)) / 10_000
    )



def _model_customers(spark, folder) -> DataFrame:
    """The clean customer table, dealt to all cores."""
    return views.customers(spark, folder, spread=True).select(*schemas.CUSTOMER_COLUMNS)


@query
def train_evaluate(spark, folder):
    fitted = training.fit_and_evaluate(_model_customers(spark, folder))
    return training.metrics_table(spark, fitted)


def _fitted_baseline(customers, order=None):
    """The baseline alone, fitted on the training rows."""
    settings = Settings()
    rows = training.split_matrix(customers, settings, order)
    train = rows.where("split = 'train'").persist()
    try:
        return training.baseline_pipeline(train.count(), settings).fit(train)
    finally:
        train.unpersist()


@query
def batch_scores(spark, folder):
    model = _fitted_baseline(_model_customers(spark, folder))
    return training.score(model, _model_customers(spark, folder), "v0", "logistic_regression")


@query
def stream_scores(spark, folder):
    model = _fitted_baseline(_model_customers(spark, folder))
    root = scratch_path(spark, "stream-scores")
    _model_customers(spark, folder).write.parquet(f"{root}/in")
    start_scoring(
        model,
        incoming_records(spark, f"{root}/in"),
        f"{root}/scores",
        f"{root}/checkpoint",
        "v0",
        "logistic_regression",
    ).awaitTermination()
    return spark.read.parquet(f"{root}/scores")


def _two_groups(spark, folder, high: int, low: int) -> DataFrame:
    """Customers of two kinds, with every field set by the kind.

    The second kind is drawn from ``high`` of 101 customers who left and ``low`` of
    101 others, so models can only learn the two shares, which SQL can follow.
    """
    rows = views.customers(spark, folder, spread=True).select("customer_id", "churn", "c_custkey")
    limit = F.when(F.col("churn") == 1, high).otherwise(low)
    second = (F.col("c_custkey") * 89) % 101 < limit

    def either(a, b) -> Column:
        return F.when(second, b).otherwise(a)

    return rows.select(
        "customer_id",
        either(5, 30).alias("tenure_months"),
        either(30.0, 90.0).alias("monthly_charges"),
        either(150.0, 2700.0).alias("total_charges"),
        either("month_to_month", "two_year").alias("contract_type"),
        either("electronic_check", "credit_card").alias("payment_method"),
        either("none", "fiber_optic").alias("internet_service"),
        *(either("No", "Yes").alias(name) for name in schemas.ADDONS),
        *(either(0, 1).alias(name) for name in schemas.FLAGS),
        "churn",
    )


@query
def train_evaluate_two_groups(spark, folder):
    """Both models at full size on customers of two kinds, measured on val and test."""
    fitted = training.fit_and_evaluate(
        _two_groups(spark, folder, 85, 20), order=_portable_hash("customer_id")
    )
    return training.metrics_table(spark, fitted)


def _two_group_scores(scores: DataFrame) -> DataFrame:
    return scores.select(
        "customer_id",
        "churn_prediction",
        F.round("churn_probability", 3).alias("churn_probability"),
        "model_version",
        "model_type",
    )


@query
def batch_scores_two_groups(spark, folder):
    """The penalised baseline's probabilities, to compare with a Newton solution."""
    customers = _two_groups(spark, folder, 85, 20)
    model = _fitted_baseline(customers, _portable_hash("customer_id"))
    return _two_group_scores(training.score(model, customers, "v0", "logistic_regression"))


@query
def stream_scores_two_groups(spark, folder):
    customers = _two_groups(spark, folder, 85, 20)
    model = _fitted_baseline(customers, _portable_hash("customer_id"))
    root = scratch_path(spark, "stream-two-groups")
    customers.write.parquet(f"{root}/in")
    start_scoring(
        model,
        incoming_records(spark, f"{root}/in"),
        f"{root}/scores",
        f"{root}/checkpoint",
        "v0",
        "logistic_regression",
    ).awaitTermination()
    return _two_group_scores(spark.read.parquet(f"{root}/scores"))


@query
def scaled_features(spark, folder):
    """The model matrix as the baseline sees it, fitted on all rows."""
    matrix = customer_model_matrix(spark, folder)
    stages = Pipeline(stages=training.scaling_stages(matrix.count()))
    scaled = stages.fit(matrix).transform(matrix)
    values = vector_to_array("features")
    return scaled.select(
        "customer_id",
        # Adding zero turns a negative zero into a plain one.
        *(
            (F.round(values[i], 6) + F.lit(0.0)).alias(name)
            for i, name in enumerate(schemas.MODEL_FEATURES)
        ),
    )


def _formula_model() -> PipelineModel:
    """A model whose probability is a known formula of the matrix."""
    share = "monthly_charges / (monthly_charges + tenure_months)"
    formula = SQLTransformer(
        statement=f"SELECT *, 1 - {share} AS p_stay, {share} AS p_leave FROM __THIS__"
    )
    join = VectorAssembler(inputCols=["p_stay", "p_leave"], outputCol="probability")
    return PipelineModel(stages=[formula, join])


@query
def formula_scores(spark, folder):
    customers = faulty_records(spark, folder)
    return training.score(_formula_model(), customers, "v1", "formula")


@query
def stream_formula_scores(spark, folder):
    root = scratch_path(spark, "stream-formula")
    faulty_records(spark, folder).write.parquet(f"{root}/in")
    start_scoring(
        _formula_model(),
        incoming_records(spark, f"{root}/in"),
        f"{root}/scores",
        f"{root}/checkpoint",
        "v1",
        "formula",
    ).awaitTermination()
    return spark.read.parquet(f"{root}/scores")


@query
def stream_quarantine(spark, folder):
    root = scratch_path(spark, "stream-quarantine")
    faulty_records(spark, folder).write.parquet(f"{root}/in")
    start_quarantine(
        incoming_records(spark, f"{root}/in"), f"{root}/bad", f"{root}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/bad").select(
        "customer_id", F.concat_ws(",", "failed_fields").alias("failed_fields")
    )


@query
def retrain_cycle(spark, folder):
    store = training.ModelStore(spark, scratch_path(spark, "models"))
    customers = _model_customers(spark, folder)
    settings = Settings(trees=50)
    training.train(customers, store, settings)
    training.retrain(customers, store, settings)
    return promotion.with_status(store.registry())


@query
def retrain_cycle_two_groups(spark, folder):
    """A first training, a better one that replaces it and a worse one that is rejected."""
    store = training.ModelStore(spark, scratch_path(spark, "models-two-groups"))
    order, settings = _portable_hash("customer_id"), Settings(trees=50)
    training.train(_two_groups(spark, folder, 75, 30), store, settings, order=order)
    for high, low in ((95, 8), (80, 25)):
        training.retrain(_two_groups(spark, folder, high, low), store, settings, order=order)
    return promotion.with_status(store.registry()).select(
        "sequence",
        "model_type",
        "promoted",
        "status",
        F.col("test_metrics.roc_auc").alias("roc_auc"),
        F.col("test_metrics.n_samples").alias("n_samples"),
    )


# --- all tables ------------------------------------------------------------


@query
def row_counts(spark, folder):
    counts = [
        views.table(spark, folder, name).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("n_rows")
        )
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)
