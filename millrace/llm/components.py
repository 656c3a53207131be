"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written


def _ordered(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .where("src <> dst")
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy(F.col("src").alias("at")).agg(F.min("dst").alias("low"))
    low = F.least("low", "src")
    return _ordered(
        both.join(least, F.col("src") == F.col("at"))
        .where("dst > src")
        .select(F.col("dst").alias("src"), low.alias("dst"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy(F.col("src").alias("at")).agg(F.min("dst").alias("low"))
    ties = edges.join(least, F.col("src") == F.col("at"))
    return _ordered(
        ties.select(F.col("dst").alias("src"), F.col("low").alias("dst")).unionByName(
            least.select(F.col("at").alias("src"), F.col("low").alias("dst"))
        )
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (src, dst longs); root is the least node.

    Each round writes its edges to the shared folder; rounds grow with the
    logarithm of the longest chain. No edges, no rows.
    """
    now = written(_ordered(edges), "edges")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    nodes = now.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    return nodes.unionByName(now.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct())
