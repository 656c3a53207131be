"""The telemetry batch job: summary per model, key skew, salted averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import Measure, keyed_agg, salted_agg, top_by
from millrace.operators.layout import add_columns, iterate

READING_COLUMNS = ["vehicle_id", "vehicle_model", "engine_temp_c", "miles_driven"]


def readings(telemetry: DataFrame, *extra: str) -> DataFrame:
    """Pings with a temperature, cut to the columns the job needs."""
    return telemetry.where(F.col("engine_temp_c").isNotNull()).select(*READING_COLUMNS, *extra)


def model_summary(telemetry: DataFrame, scale: int | None = None) -> DataFrame:
    """Mean temperature, readings and miles per vehicle model, in model order."""
    measures = {
        "avg_engine_temp_c": Measure("avg", "engine_temp_c", scale),
        "reading_count": Measure("count"),
        "total_miles_driven": Measure("sum", "miles_driven", scale),
    }
    return keyed_agg(readings(telemetry), ["vehicle_model"], measures).orderBy("vehicle_model")


VEHICLE = ["vehicle_id", "vehicle_model"]


def averages(scale: int | None = None) -> dict[str, Measure]:
    return {
        "avg_engine_temp_c": Measure("avg", "engine_temp_c", scale),
        "total_readings": Measure("count"),
    }


def vehicle_averages(
    telemetry: DataFrame,
    row_key: list[str],
    scale: int | None = None,
    salted: bool = True,
    buckets: int = 8,
) -> DataFrame:
    """Mean temperature and readings per vehicle; hot vehicles split by a salt."""
    measures, keys = averages(scale), VEHICLE
    rows = readings(telemetry, *(k for k in row_key if k not in READING_COLUMNS))
    if not salted:
        return keyed_agg(rows, keys, measures)
    return salted_agg(rows, keys, measures, row_key, buckets)


def busiest_vehicles(averages: DataFrame, n: int = 10) -> DataFrame:
    return top_by(averages, "total_readings", ["vehicle_id", "vehicle_model"], n)


def adjusted_temperature(i: int):
    return F.col("engine_temp_c") + F.lit(0.001 * i)


def adjusted_readings(telemetry: DataFrame, rounds: int = 60) -> DataFrame:
    """Readings with ``temp_adj_1..rounds``; rows are independent, so one projection."""
    columns = {f"temp_adj_{i}": adjusted_temperature(i) for i in range(1, rounds + 1)}
    return add_columns(readings(telemetry), columns)


def adjusted_readings_iterated(
    telemetry: DataFrame, rounds: int = 60, cut_every: int | None = 10
) -> DataFrame:
    """The same, one round at a time with a checkpoint every few rounds."""

    def step(df: DataFrame, i: int) -> DataFrame:
        return df.withColumn(f"temp_adj_{i}", adjusted_temperature(i))

    return iterate(readings(telemetry), step, rounds, cut_every)
