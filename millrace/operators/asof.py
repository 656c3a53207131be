"""As-of lookup: what was valid at a time, without a range join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import stored


def _filled(by: Sequence[str]) -> dict[str, Column]:
    """Keys without nulls, so that plain equality matches null keys too."""
    out = {}
    for i, name in enumerate(by):
        out[f"_key{i}"] = F.coalesce(F.col(name).cast("string"), F.lit(""))
        out[f"_null{i}"] = F.col(name).isNull()
    return out


def as_of(
    questions: DataFrame,
    at: str,
    history: DataFrame,
    since: str,
    values: Sequence[str],
    by: Sequence[str] = (),
    ties: Sequence[str] = (),
) -> DataFrame:
    """The questions with the ``values`` of the latest history row of their ``by`` keys
    that is not later than ``at``; null before the first.

    Of history rows of the same time the last in ``ties`` counts. Both sides become one table,
    range-partitioned by keys and time, so a key with a third of all rows is many partitions.
    Within a partition the last value seen is carried forward; what a partition starts with comes
    from the last values of the key's earlier ones, one row per partition and key.
    """
    clash = set(values) & set(questions.columns)
    if clash:
        raise ValueError(f"questions have columns of these names already: {sorted(clash)}")
    known = history.where(F.col(since).isNotNull()).select(
        *(F.col(b).alias(b) for b in by),
        F.col(since).alias("_at"),
        F.lit(0).alias("_side"),
        F.struct(*ties).alias("_tie") if ties else F.lit(0).alias("_tie"),
        F.struct(*values).alias("_value"),
    )
    asked = questions.select(
        *(F.col(b).alias(b) for b in by),
        F.col(at).alias("_at"),
        F.lit(1).alias("_side"),
        F.struct(*questions.columns).alias("_asked"),
    )
    both = known.unionByName(asked, allowMissingColumns=True)
    order = [*by, F.asc_nulls_first("_at"), "_side", "_tie"]
    placed = stored(both.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "as-of")
    placed = placed.withColumns(_filled(by))
    keys = list(_filled(by))
    seen = W.partitionBy("_part", *keys).orderBy(F.asc_nulls_first("_at"), "_side", "_tie")
    now = F.last("_value", ignorenulls=True).over(seen.rowsBetween(W.unboundedPreceding, 0))
    newest = F.max_by("_value", F.struct("_at", "_tie"))
    ends = placed.where("_side = 0").groupBy("_part", *keys).agg(newest.alias("_last"))
    # Every partition of a key, those without history among them, starts with an earlier end.
    parts = placed.select("_part", *keys).distinct().join(ends, ["_part", *keys], "left")
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select("_part", *keys, F.last("_last", ignorenulls=True).over(earlier).alias("_start"))
    found = placed.withColumn("_now", now).where("_side = 1").join(starts, ["_part", *keys])
    value = F.when(F.col("_at").isNotNull(), F.coalesce("_now", "_start"))
    return found.select("_asked.*", *(value.getField(v).alias(v) for v in values))
