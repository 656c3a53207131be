"""Running totals over groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import stored


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    """Null-safe equality of key columns."""
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    return condition


def running_totals(
    rows: DataFrame,
    groups: Sequence[str],
    order: str,
    measures: Mapping[str, Column],
    ranges: int | None = None,
) -> DataFrame:
    """Tally rows per group and ``order`` value, with running and full totals.

    ``measures`` names whole-number expressions over a row. The result has one
    row per group and value with each measure's sum ``m``, the group's sum over
    smaller values ``m_before`` and over all values ``m_total``.

    A window over a whole group would put a large group in one task. So the tally,
    one row per group and value, is range-partitioned by both and stored: the source is read
    once. Pairs of group and value are distinct, so the partitions are even however the rows
    are spread, infinite values included. Totals run within a partition; the totals of a
    group's earlier partitions, as many rows as partitions and groups, are added.
    """
    sums = [F.sum(value).alias(name) for name, value in measures.items()]
    tally = rows.groupBy(*groups, order).agg(*sums)
    places = [*groups, order]
    # ``ranges`` None leaves their number to the session and its adaptive planning.
    ranged = tally.repartitionByRange(*([ranges] if ranges else []), *places)
    placed = stored(ranged.withColumn("_part", F.spark_partition_id()), "tally")

    # Keys without nulls: plain equality then matches null groups too, and the
    # join below reuses the partitioning of the window.
    filled = {}
    for i, name in enumerate(groups):
        filled[f"_key{i}"] = F.coalesce(F.col(name).cast("string"), F.lit(""))
        filled[f"_null{i}"] = F.col(name).isNull()
    placed = placed.withColumns(filled)
    keys = ["_part", *filled]
    below = W.partitionBy(*filled).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    everywhere = W.partitionBy(*filled)
    per_part = (
        placed.groupBy(*keys)
        .agg(*(F.sum(m).alias(m) for m in measures))
        .select(
            *keys,
            *(F.coalesce(F.sum(m).over(below), F.lit(0)).alias(f"_lower_{m}") for m in measures),
            *(F.sum(m).over(everywhere).alias(f"{m}_total") for m in measures),
        )
    )
    before = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    within = placed.withColumns(
        {f"_within_{m}": F.coalesce(F.sum(m).over(before), F.lit(0)) for m in measures}
    )
    return within.join(per_part, keys).select(
        *groups,
        order,
        *measures,
        *((F.col(f"_within_{m}") + F.col(f"_lower_{m}")).alias(f"{m}_before") for m in measures),
        *(f"{m}_total" for m in measures),
    )
