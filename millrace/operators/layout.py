"""Partition layout, table writes and checkpointed iteration."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import shared_dir


def hash_layout(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Rows with equal keys in the same one of ``n`` partitions."""
    return df.repartition(n, *keys)


def range_layout(df: DataFrame, *keys: str, n: int | None = None) -> DataFrame:
    """Contiguous key ranges per partition; Spark samples the boundaries."""
    return df.repartitionByRange(n, *keys) if n else df.repartitionByRange(*keys)


def write_by_day(df: DataFrame, path: str, time_column: str) -> None:
    """Write one folder per day so a time filter reads only its days.

    The shuffle ranges over the full timestamp, not the day: a busy day is
    spread over several tasks and a task holds few days, hence few files.
    """
    daily = df.withColumn("event_day", F.to_date(time_column))
    laid_out = range_layout(daily, time_column)
    laid_out.write.mode("overwrite").partitionBy("event_day").parquet(path)


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_split(df: DataFrame, path: str, column: str = "part", form: str = "csv") -> None:
    """Write each part of a split to its own folder ``<column>=<part>``, in one pass."""
    writer = df.write.mode("overwrite").partitionBy(column)
    writer.format(form).option("header", True).save(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there.

    The copy survives the loss of any executor. A shuffle below the cut runs
    once: the write reuses its files.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def iterate(
    df: DataFrame,
    step: Callable[[DataFrame, int], DataFrame],
    rounds: int,
    cut_every: int | None = 10,
) -> DataFrame:
    """Apply ``step(df, i)`` for i = 1..rounds, cutting the lineage on the way.

    Each cut writes the whole table, which pays off when a step shuffles. For
    a chain of pure projections use :func:`add_columns`, or ``cut_every=None``.
    """
    for i in range(1, rounds + 1):
        df = step(df, i)
        if cut_every and i % cut_every == 0:
            df = cut_lineage(df)
    return df


def add_columns(df: DataFrame, columns: dict, order: Sequence[str] | None = None) -> DataFrame:
    """Many computed columns in a single projection."""
    out = df.withColumns(columns)
    return out.select(*order) if order else out
