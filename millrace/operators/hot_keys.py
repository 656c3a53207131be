"""Keys that hold a large share of the rows, from mergeable sketches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import Measure, keyed_agg, salted_agg

#: Keys that a sketch tracks: any key of more than a 750th of the rows is among them.
_TRACKED = 1_000



def _digest(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_key_state(df: DataFrame, keys: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """(``state``, ``n_rows``) per group, such as a batch; reads only the keys."""
    digests = df.select(*groups, _digest(keys).alias("_digest"))
    aggregates = F.expr(f"approx_top_k_accumulate(_digest, {_TRACKED})").alias("state"), F.count("*").alias("n_rows")
    # A group even if there is but one: tasks without rows then send no state.
    return digests.groupBy(*(groups or [F.lit(0).alias("_all")])).agg(*aggregates).drop("_all")


def hot_digests(states: DataFrame, share: float) -> list[int]:
    """Digests of keys that may hold ``share`` of the rows behind all states; at most ``_TRACKED``.

    Estimates are never below the count, so no such key is missed while ``share`` is above
    what the sketch resolves; a key too many does no harm.
    """
    states = states.where("n_rows > 0")
    top = states.groupBy(F.lit(0).alias("_all")).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(state, {_TRACKED}), {_TRACKED})").alias("top"),
        F.sum("n_rows").alias("n_rows"),
    ).first()
    return sorted(x.item for x in (top.top if top else ()) if x["count"] >= share * top.n_rows)


def selectively_salted_agg(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Measure],
    row_key: Sequence[str],
    share: float = 0.01,
    buckets: int = 8,
    states: DataFrame | None = None,
) -> DataFrame:
    """The same result as :func:`keyed_agg`; only keys of at least ``share`` of the rows are salted.

    ``states`` of earlier batches save the pass that names these keys.
    """
    hot = hot_digests(states if states is not None else hot_key_state(df, keys), share)
    if not hot:
        return keyed_agg(df, keys, measures)
    is_hot = _digest(keys).isin(hot)
    rest = keyed_agg(df.where(~is_hot), keys, measures)
    return rest.unionByName(salted_agg(df.where(is_hot), keys, measures, row_key, buckets))
