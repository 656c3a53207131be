"""Mixing sources to target sizes along a curriculum that changes over time.

Every source has a target number of words and a schedule: its rate over the
training time 0..1, piecewise linear. The schedule's integral is the source's
cumulative demand. A source's documents stand in a fixed shuffled order; the
words before a document are its place in that order, and inverting the demand at
that place gives the time at which training reaches the document. Documents are
range-sorted by that time.

DataFrame functions only. Nulls: a null text has size 0, a null source is a
source of its own that comes last, a null doc_id is shuffled like any other.
Empty tables give empty results. Repeated rows each take their own share.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import WORD, set_aside, text_or_empty, written

Schedule = Sequence[tuple[float, float]]

#: Early, even and late sources, by turns.
RAMPS: tuple[Schedule, ...] = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)),
)


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def integrated(schedule: Schedule) -> list[tuple[float, float, float, float]]:
    """Segments (start, rate, slope, demand before), scaled to a demand of 1 in all."""
    area = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))
    if not area > 0 or any(w < 0 for _, w in schedule):
        raise ValueError("a schedule needs weights of 0 or more and a positive integral")
    out, before = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        out.append((t0, w0 / area, (w1 - w0) / (t1 - t0) / area, before))
        before += (t1 - t0) * (w0 + w1) / 2 / area
    return out


def time_of(demand: Column, schedule: Schedule) -> Column:
    """When cumulative demand, as a share of the target, reaches a value."""
    out = None
    for start, rate, slope, before in integrated(schedule):
        rest = demand - before
        root = F.sqrt(F.greatest(F.lit(rate * rate) + 2 * slope * rest, F.lit(0.0)))
        here = F.when(rest > 0, start + 2 * rest / (rate + root)).otherwise(F.lit(start))
        out = here if out is None else F.when(demand >= before, here).otherwise(out)
    return out


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float):
    """Words wanted of each source: by weight, at most ``most`` times its size.

    ``sizes`` has one row per source. What a source cannot give is shared among
    the rest by weight until no source is above its bound: sources meet their
    bound in the order of bound per weight, so running sums in that order give
    the final level at once.
    """
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    bound = most * F.col("source_size").cast("double")
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), F.col("turn") % len(weights) + 1)
    ranked = (
        sizes.withColumn("turn", turn)
        .withColumn("bound", bound)
        .withColumn("weight", weight)
        .withColumn("full_at", F.col("bound") / F.col("weight"))
    )
    rising = W.orderBy("full_at", "turn").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(0))
    wanted = share * F.sum("source_size").over(everything).cast("double")
    level = (wanted - F.coalesce(F.sum("bound").over(rising), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(rising), F.lit(0.0))
    )
    levels = ranked.withColumn("level", level).withColumn("full", F.col("full_at") <= F.col("level"))
    first_open = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return levels.select(
        "source",
        "source_size",
        "turn",
        F.when(F.col("full"), F.col("bound")).otherwise(first_open * F.col("weight")).alias("target"),
    )


def _prefix(df: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    before = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    schedules: Sequence[Schedule] = RAMPS,
) -> DataFrame:
    """The documents with what the mix takes of each and when.

    Adds mix_size, mix_source_size, mix_target, mix_taken and mix_times, the
    times (0..1) of each pass over the document. Order within a source is by
    the digest of doc_id, so reruns agree on any cluster. Columns of these names that
    docs has already are replaced.

    A source may hold any share of the rows: running sums go over 256 and again
    256 digest ranges of partial sums, then within one range of the source.
    """
    docs = docs.drop("mix_size", "mix_source_size", "mix_target", "mix_taken", "mix_times")
    given, back = set_aside(docs, ("doc_id", "text", "source"))
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    placed = given.select(
        *given.columns,
        word_count().alias("mix_size"),
        digest.alias("mix_digest"),
        F.substring(digest, 1, 2).alias("mix_r1"),
        F.substring(digest, 3, 2).alias("mix_r2"),
    )
    fine = written(
        placed.groupBy("source", "mix_r1", "mix_r2").agg(F.sum("mix_size").alias("words")), "mix"
    )
    coarse = fine.groupBy("source", "mix_r1").agg(F.sum("words").alias("coarse_words"))
    sizes = coarse.groupBy("source").agg(F.sum("coarse_words").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    coarse = _prefix(coarse, ["source"], "mix_r1", "coarse_words", "coarse_before")
    coarse = coarse.join(
        targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
    ).drop("s", "coarse_words")
    fine = _prefix(fine, ["source", "mix_r1"], "mix_r2", "words", "fine_before")
    starts = fine.join(
        coarse.select(F.col("source").alias("s"), F.col("mix_r1").alias("r1"), *coarse.columns[2:]),
        F.col("source").eqNullSafe(F.col("s")) & (F.col("mix_r1") == F.col("r1")),
    ).select(
        F.col("source").alias("mix_s"),
        F.col("mix_r1").alias("mix_s1"),
        F.col("mix_r2").alias("mix_s2"),
        (F.col("coarse_before") + F.col("fine_before")).alias("mix_start"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        F.col("turn").alias("mix_turn"),
    )
    within = (
        W.partitionBy("source", "mix_r1", "mix_r2")
        .orderBy("mix_digest", "mix_size")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    rows = placed.withColumn(
        "mix_within", F.coalesce(F.sum("mix_size").over(within), F.lit(0))
    ).join(
        starts,
        F.col("source").eqNullSafe(F.col("mix_s"))
        & (F.col("mix_r1") == F.col("mix_s1"))
        & (F.col("mix_r2") == F.col("mix_s2")),
    )
    begin = F.col("mix_start") + F.col("mix_within")
    budget = F.floor("mix_target")
    rounds = math.ceil(most)
    part = [
        F.greatest(
            F.lit(0).cast("long"),
            F.least(F.col("mix_size"), budget - begin - n * F.col("mix_source_size")),
        )
        for n in range(rounds)
    ]
    kinds = len(schedules)
    times = []
    for n in range(rounds):
        demand = (begin + n * F.col("mix_source_size")) / F.col("mix_target")
        when = F.lit(None).cast("double")
        for kind, schedule in enumerate(schedules):
            when = F.when(F.col("mix_turn") % kinds == kind, time_of(demand, schedule)).otherwise(when)
        times.append(F.when(part[n] > 0, when))
    return rows.select(
        *back,
        "mix_size",
        "mix_source_size",
        "mix_target",
        sum(part[1:], part[0]).alias("mix_taken"),
        F.array_compact(F.array(*times)).alias("mix_times"),
    )


def in_training_order(docs: DataFrame, **options) -> DataFrame:
    """One row per pass over a taken document, range-sorted by training time.

    A document taken in part comes whole; one the mix does not take is left out.
    Ties in time are ordered by doc_id.
    """
    rows, back = set_aside(docs, ("doc_id", "text", "source"))
    mixed = mix(rows, **options).withColumn("mix_time", F.explode("mix_times"))
    return mixed.orderBy("mix_time", "doc_id").select(*back)
