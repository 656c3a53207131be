"""Telemetry and customer views over the shared TPC-H-like tables.

Expressions are integer arithmetic where they can be, so that another SQL
engine computes the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.cleaning import clean_customers


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_out(rows: DataFrame) -> DataFrame:
    """The rows over at least as many tasks as the session has cores.

    A file of few row groups is read by as few tasks, and so is all computed from it up to
    the next shuffle. Dealt by a hash of all columns, rows need no sort to be dealt alike again.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, *rows.columns)


def telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """Events as device pings; nine tenths fall on five hot vehicles."""
    events = table(spark, folder, "events")
    hot = F.col("event_id") % 20 < 18
    number = F.when(hot, F.col("event_id") % 5).otherwise(F.col("user_id"))
    prefix = F.when(hot, "VHOT00").otherwise("V")
    return events.select(
        "event_id",
        F.concat(prefix, number.cast("string")).alias("vehicle_id"),
        F.concat(F.lit("M"), (number % 4).cast("string")).alias("vehicle_model"),
        F.col("ts").alias("event_time"),
        F.when(F.col("event_id") % 97 != 0, F.col("value")).alias("engine_temp_c"),
        ((F.col("event_id") % 1100).cast("double") / F.lit(10.0)).alias("speed_kmph"),
        ((F.col("event_id") % 50).cast("double") / F.lit(10.0)).alias("miles_driven"),
    )


def _share(multiplier: int, below: int) -> Column:
    return (F.col("c_custkey") * multiplier) % 100 < below


def _yes_no(multiplier: int, below: int) -> Column:
    return F.when(_share(multiplier, below), "Yes").otherwise("No")


# Fixed values of the view: (multiplier, percentage of Yes) per column.
_ADDON_SHARES = {
    "OnlineSecurity": (19, 30),
    "OnlineBackup": (23, 35),
    "DeviceProtection": (29, 35),
    "TechSupport": (31, 30),
    "StreamingTV": (41, 40),
    "StreamingMovies": (43, 40),
}
_FLAG_SHARES = {
    "Partner": (53, 48),
    "Dependents": (59, 30),
    "PhoneService": (61, 90),
    "PaperlessBilling": (71, 59),
}


def raw_customers(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """Customers in the raw export layout, with its blanks and odd spellings.

    Also keeps the key, nation and balance of the source row. ``spread`` deals the source
    rows to all cores first.
    """
    c = F.col("c_custkey")
    tenure = ((c * 37) % 73).cast("int")
    internet = (c * 17) % 9
    contract = (c * 11) % 7
    pay = (c * 5) % 4
    risk = (
        F.when(contract > 1, 40).otherwise(0)
        + F.when(internet >= 5, 20).otherwise(0)
        - tenure
        + (c * 6151) % 100
    )
    columns = {
        "customerID": F.concat(F.lit("C"), c.cast("string")),
        "tenure": tenure,
        "MonthlyCharges": (1825 + (c * 7919) % 10000).cast("double") / F.lit(100.0),
        "TotalCharges": F.when(tenure == 0, " ").otherwise((tenure * 20).cast("string")),
        "Contract": F.when((c * 13) % 101 == 0, "Month to month")
        .when(contract == 0, "One year")
        .when(contract == 1, "Two year")
        .otherwise("Month-to-month"),
        "PaymentMethod": F.when(pay == 0, "Electronic check")
        .when(pay == 1, "Mailed check")
        .when(pay == 2, "Bank transfer (automatic)")
        .otherwise("Credit card (automatic)"),
        "InternetService": F.when(internet < 2, "No")
        .when(internet < 5, "DSL")
        .otherwise("Fiber optic"),
        **{
            name: F.when(internet < 2, "No internet service").otherwise(_yes_no(m, r))
            for name, (m, r) in _ADDON_SHARES.items()
        },
        "SeniorCitizen": F.when(_share(47, 16), 1).otherwise(0),
        **{name: _yes_no(m, r) for name, (m, r) in _FLAG_SHARES.items()},
        "MultipleLines": F.when((c * 61) % 100 >= 90, "No phone service").otherwise(
            _yes_no(67, 42)
        ),
        "Churn": F.when(risk > 85, "Yes").otherwise("No"),
    }
    source = table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"
    )
    return (spread_out(source) if spread else source).select(
        *(columns[name].alias(name) for name in schemas.RENAMES),
        "c_custkey",
        "c_nationkey",
        "c_mktsegment",
        "c_acctbal",
    )


def customers(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """The clean customer table plus key, nation, market segment and balance."""
    keep = ("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    return clean_customers(raw_customers(spark, folder, spread), keep)
