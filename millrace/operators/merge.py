"""Union, keep-last deduplication and upsert."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def concat(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; a column some table lacks reads null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def keep_last(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row per key; rows without a key count as one key.

    Spark turns the row-number filter into a per-task limit below the shuffle,
    so a key with very many copies sends one row per task.
    """
    newest_first = W.partitionBy(key).orderBy(*(F.desc(c) for c in order))
    numbered = df.withColumn("_nth", F.row_number().over(newest_first))
    return numbered.where("_nth = 1").drop("_nth")


def merge_latest(
    base: DataFrame,
    batch: DataFrame,
    key: str,
    order: list[str],
    base_keys_unique: bool = False,
) -> DataFrame:
    """Upsert: rows of ``batch`` replace those of ``base`` with the same key.

    ``batch`` must come later in ``order`` than ``base``. Once ``base`` holds
    each key once, only the batch needs deduplication and the base is kept but
    for its replaced keys. While Spark finds these small enough to broadcast, the
    base is filtered in place, without a shuffle.
    """
    if not base_keys_unique:
        return keep_last(concat(base, batch), key, order)
    fresh = keep_last(batch, key, order)
    replaced = batch.select(F.col(key).alias("_key")).distinct()
    kept = base.join(replaced, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    return concat(kept, fresh)
