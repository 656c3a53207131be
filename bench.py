"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.
``queries`` holds the headline queries (seconds to compute every output row),
``variants`` pairs of ways to the same result.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.merge import concat, keep_last
from millrace.plans import catalog, telemetry, views
from millrace.session import local_session

HEADLINE = [
    "telemetry_model_summary",
    "telemetry_from_csv",
    "telemetry_skew_profile",
    "telemetry_salted_avg",
    "telemetry_top_vehicles",
    "telemetry_range_layout",
    "telemetry_iterated",
    "telemetry_iterated_checkpointed",
    "customer_clean",
    "customer_model_matrix",
    "record_validation",
    "positional_split",
    "stratified_split",
    "merge_latest",
    "merge_latest_incremental",
    "stream_ingest",
    "quality_report",
    "drift_report",
    "drift_by_batch",
    "roc_auc_by_source",
    "latency_summary",
    "promotion_decisions",
    "retrain_decisions",
    "registry_status",
    "train_evaluate",
    "batch_scores",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def variants(spark, folder) -> dict:
    """The same results reached in two ways, each warm."""
    pings = views.telemetry(spark, folder)
    customers = views.customers(spark, folder).select(*schemas.CUSTOMER_COLUMNS, "c_custkey")
    twice = concat(
        customers.withColumn("b", F.lit(0)), customers.withColumn("b", F.lit(1))
    )

    def by_struct() -> DataFrame:
        newest = F.max_by(F.struct(*twice.columns), F.struct("b", "c_custkey"))
        return twice.groupBy("customer_id").agg(newest.alias("r")).select("r.*")

    def one_window() -> DataFrame:
        place = F.row_number().over(W.orderBy("c_custkey"))
        return customers.withColumn("place", place)

    ways = {
        "average_plain": lambda: telemetry.vehicle_averages(pings, ["event_id"], 2, False),
        "average_salted": lambda: telemetry.vehicle_averages(pings, ["event_id"], 2, True),
        "sum_double": lambda: telemetry.model_summary(pings),
        "sum_exact": lambda: telemetry.model_summary(pings, 2),
        "sixty_rounds_checkpointed": lambda: telemetry.adjusted_readings_iterated(pings),
        "sixty_rounds_one_select": lambda: telemetry.adjusted_readings(pings),
        "dedupe_max_by": by_struct,
        "dedupe_row_number": lambda: keep_last(twice, "customer_id", ["b", "c_custkey"]),
        "split_by_rank_cut": lambda: catalog.ranks.positional_split(customers, ["c_custkey"], 0.9),
        "split_by_one_window": one_window,
    }
    out = {}
    for name, way in ways.items():
        run(way())
        out[name] = timed(lambda way=way: run(way()))
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("millrace-bench", os.environ.get("BENCH_CPUS", "8"), memory="12g")
    run(views.table(spark, folder, "events"))
    queries = {
        name: timed(lambda name=name: run(catalog.QUERIES[name](spark, folder)))
        for name in HEADLINE
    }
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": float(scale.group(1)) if scale else None,
                "variants": variants(spark, folder),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
