"""Exact rank cuts without a global sort: positional and stratified splits.

A window over a whole table is one task. To split at an exact rank only one
value is needed: the key of the row at that rank. Numbers, dates and times: a sketch of the
keys brackets the rank in the pass that counts them, and exact counts below and in
the bracket finish it, after further sketches inside if it holds very many rows. Texts:
rows are counted per leading characters, the range that holds the rank is chosen, and
so on inside it. Every pass is an aggregation with partial sums; rows are not moved.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.layout import cut_lineage

# A pass over texts returns as many ranges as there are characters at one place; once a
# range or bracket is expected to hold few rows, the distinct keys in it are returned.
_FEW = 50_000
# Size of a sketch, quantiles taken from it, and by how many of these a rank may be off:
# five times the sketch's normalised error at that size.
_SKETCH, _QUANTILES, _SLACK = 8_000, 1_024, 4


class TiedRank(ValueError):
    """The keys do not tell apart the rows on both sides of a cut."""


def _shared(low: str, high: str) -> int:
    """Length of the common start."""
    return next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))


class _Texts:
    """Ranges of strings: the leading characters, one more than a range shares."""

    def __init__(self, low: str, high: str, longest: int):
        self.exact = longest
        self.first = min(_shared(low, high) + 1, longest)

    def range_of(self, key: str, level: int) -> Column:
        return F.col(key) if level == self.exact else F.substring(key, 1, level)

    def parent(self, value: str, level: int, coarser: int) -> str:
        return value[:coarser]

    def finer(self, level: int, spans: list[tuple]) -> int:
        return min(min(_shared(low, high) for low, high in spans) + 1, self.exact)


def _any(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out


def _measure(df: DataFrame, key: str) -> tuple[Column, str] | None:
    """A number that never falls where the key rises, and the sketches for it; None for text."""
    kind, column = df.schema[key].dataType, F.col(key)
    if isinstance(kind, T.StringType):
        return None
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long"), "bigint"
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column), "bigint"
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return column.cast("long"), "bigint"
    # NaN is the largest number in Spark's order.
    return F.nanvl(column.cast("double"), F.lit(math.inf)), "double"


def _quantiles(number: Column, kind: str) -> Column:
    """Evenly spaced quantiles of the numbers that are not null; null if there are none."""
    sketch = getattr(F, f"kll_sketch_agg_{kind}")(number, F.lit(_SKETCH))
    places = F.array(*(F.lit(i / _QUANTILES) for i in range(_QUANTILES + 1)))
    return F.when(F.count(number) > 0, getattr(F, f"kll_sketch_get_quantile_{kind}")(sketch, places))


@dataclass(frozen=True)
class Limits:
    """Rows of a group, the span of their keys and quantiles of keys that are numbers."""

    n: int
    low: object
    high: object
    longest: int
    quantiles: list | None = None


def key_limits(df: DataFrame, key: str, group: Column) -> dict:
    """Limits per group value, in one pass."""
    number = _measure(df, key)
    found = (
        df.groupBy(group.alias("_group"))
        .agg(
            F.count("*").alias("n"),
            F.count(key).alias("keyed"),
            F.min(key).alias("low"),
            F.max(key).alias("high"),
            (F.lit(0) if number else F.max(F.length(key))).alias("longest"),
            (_quantiles(*number) if number else F.lit(None)).alias("quantiles"),
        )
        .collect()
    )
    if any(row.n != row.keyed for row in found):
        raise ValueError(f"rows without {key} have no place in the order")
    return {row["_group"]: Limits(row.n, row.low, row.high, row.longest, row.quantiles) for row in found}


@dataclass(frozen=True)
class _Region:
    """Keys between two bounds (None: open) that hold ``n`` rows, the wanted one as the
    ``togo``-th; ``quantiles`` of them if a sketch was made."""

    low: object
    high: object
    n: int
    togo: int
    quantiles: list | None

    def holds(self, number: Column) -> Column:
        inside = F.lit(True)
        if self.low is not None:
            inside = inside & (number > F.lit(self.low))
        if self.high is not None:
            inside = inside & (number < F.lit(self.high))
        return inside

    def bracket(self) -> tuple:
        """Two keys between which the wanted row is expected, and the rows expected there."""
        q = self.quantiles
        at = self.togo * _QUANTILES // self.n
        first, last = max(at - _SLACK, 0), min(at + 1 + _SLACK, _QUANTILES)
        return q[first], q[last], 0 if q[first] == q[last] else self.n * (last - first) // _QUANTILES


def _locate_number(df: DataFrame, key: str, group: Column, wanted: list[tuple], limits: dict) -> dict:
    """As :func:`_locate`, by quantile sketches and exact counts.

    A bracket's own ends are counted apart, so each pass leaves fewer keys even where
    many rows share one; a rank outside its bracket is looked for on that side.
    """
    number, kind = _measure(df, key)
    rows = df.select(group.alias("_group"), key, number.alias("_measure"))
    number, out = F.col("_measure"), {}
    state = {
        (g, rank): _Region(None, None, limits[g].n, rank, limits[g].quantiles) for g, rank in wanted
    }
    while state:
        # Narrow: the keys themselves are counted. Wide: only the bracket's parts, and its
        # inside is sketched.
        parts, narrow_ones, wide_ones, per_key = {}, [], [], F.lit(False)
        for n, (target, region) in enumerate(state.items()):
            low, high, expected = region.bracket() if region.quantiles else (None, None, region.n)
            of_group = F.col("_group").eqNullSafe(F.lit(target[0])) & region.holds(number)
            part = F.when(of_group, 2)
            if low is not None:
                part = (
                    F.when(of_group & (number < F.lit(low)), 0)
                    .when(of_group & (number == F.lit(low)), 1)
                    .when(of_group & (number < F.lit(high)), 2)
                    .when(of_group & (number == F.lit(high)), 3)
                    .when(of_group, 4)
                )
            ends = part.isin(1, 3)
            if expected <= _FEW:
                narrow_ones.append(part.alias(f"_p{n}"))
                per_key = per_key | F.coalesce(ends | (part == 2), F.lit(False))
            else:
                wide_ones += [F.count_if(part == i).alias(f"_p{n}_{i}") for i in (0, 2, 4)]
                wide_ones.append(_quantiles(F.when(part == 2, number), kind).alias(f"_q{n}"))
                narrow_ones.append(F.when(ends, part).alias(f"_p{n}"))
                per_key = per_key | F.coalesce(ends, F.lit(False))
            parts[target] = (n, low, high, expected <= _FEW)
        names = [f"_p{n}" for n in range(len(parts))]
        counted = (
            rows.select("_group", F.when(per_key, F.col(key)).alias("_key"), *narrow_ones)
            .where(_any([F.col(n).isNotNull() for n in names]))
            .groupBy("_group", "_key", *names)
            .agg(F.count("*").alias("n"))
            .collect()
        )
        wide = {r["_group"]: r for r in rows.groupBy("_group").agg(*wide_ones).collect()} if wide_ones else {}
        following = {}
        for target, region in state.items():
            n, low, high, narrow = parts[target]
            mine = [r for r in counted if r["_group"] == target[0] and r[f"_p{n}"] is not None]
            togo = region.togo
            for part in range(5):
                keys: dict = defaultdict(int)
                for r in mine:
                    if r[f"_p{n}"] == part:
                        keys[r["_key"]] += r.n
                by_key = narrow or part in (1, 3)
                size = sum(keys.values()) if by_key else wide[target[0]][f"_p{n}_{part}"]
                if togo > size:
                    togo -= size
                    continue
                if by_key and part in (1, 2, 3):
                    for value in sorted(keys, key=lambda v: (v != v, v)):
                        if togo <= keys[value]:
                            out[target] = (value, togo, keys[value])
                            break
                        togo -= keys[value]
                elif part == 2:
                    bounds = (region.low, region.high) if low is None else (low, high)
                    following[target] = _Region(*bounds, size, togo, wide[target[0]][f"_q{n}"])
                else:
                    bounds = (region.low, low) if part == 0 else (high, region.high)
                    following[target] = _Region(*bounds, size, togo, None)
                break
        state = following
    return out


def _locate(
    df: DataFrame, key: str, group: Column, wanted: list[tuple], limits: dict
) -> dict:
    """For each (group value, rank): key value there, rank among its equals, equals."""
    if _measure(df, key):
        return _locate_number(df, key, group, wanted, limits)
    groups = {g for g, _ in wanted}
    rows = df.select(group.alias("_group"), key)
    rows = rows.where(_any([F.col("_group").eqNullSafe(F.lit(g)) for g in groups]))
    ranges = _Texts(
        min(limits[g].low for g in groups),
        max(limits[g].high for g in groups),
        max(limits[g].longest for g in groups),
    )
    few = max(limits[g].n for g in groups) <= _FEW
    level = ranges.exact if few else ranges.first
    coarser = None
    # per target: chosen range, rank still to go inside it, rows inside it
    state = {target: (None, target[1], limits[target[0]].n) for target in wanted}
    span: dict[tuple, tuple] = {}
    while True:
        scope = rows
        if coarser is not None:
            chosen = {(target[0], at) for target, (at, _, _) in state.items()}
            scope = rows.where(
                _any(
                    [
                        F.col("_group").eqNullSafe(F.lit(g))
                        & (ranges.range_of(key, coarser) == F.lit(at))
                        for g, at in chosen
                    ]
                )
            )
        counted = scope.groupBy("_group", ranges.range_of(key, level).alias("_range")).agg(
            F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
        )
        per_group = defaultdict(list)
        for row in counted.collect():
            per_group[row["_group"]].append((row["_range"], row.n, row.low, row.high))
        for target, (at, togo, _) in state.items():
            for value, n, low, high in sorted(per_group[target[0]]):
                if coarser is not None and ranges.parent(value, level, coarser) != at:
                    continue
                if togo <= n:
                    state[target] = (value, togo, n)
                    span[target] = (low, high)
                    break
                togo -= n
        open_spans = [(low, high) for low, high in span.values() if low != high]
        if not open_spans:
            # Each chosen range is a single key.
            return {t: (span[t][0], togo, n) for t, (_, togo, n) in state.items()}
        coarser = level
        inside = max(n for _, _, n in state.values())
        level = ranges.exact if inside <= _FEW else ranges.finer(level, open_spans)


def rank_cuts(
    df: DataFrame,
    keys: Sequence[str],
    wanted: list[tuple],
    group: Column,
    limits: dict | None = None,
) -> dict:
    """The key values of the rows at the wanted (group value, rank) places.

    ``keys`` are columns of numbers, dates, times or text, compared in turn; later ones are
    looked at only among rows equal in the earlier ones. The result gives, per
    wanted pair, the leading key values that decide the cut.
    """
    limits = limits or key_limits(df, keys[0], group)
    cuts = {}
    located = _locate(df, keys[0], group, wanted, limits)
    for (g, rank), (value, place, equals) in located.items():
        if place == equals:
            cuts[g, rank] = (value,)
        elif len(keys) == 1:
            raise TiedRank(f"{equals} rows share {keys[0]} = {value}")
        else:
            among = df.where(group.eqNullSafe(F.lit(g)) & (F.col(keys[0]) == F.lit(value)))
            rest = rank_cuts(among, keys[1:], [(0, place)], F.lit(0))
            cuts[g, rank] = (value, *rest[0, place])
    return cuts


def _up_to(keys: Sequence[str], values: tuple) -> Column:
    last = len(values) - 1
    inside = F.col(keys[last]) <= F.lit(values[last])
    for key, value in list(zip(keys, values))[:last][::-1]:
        inside = (F.col(key) < F.lit(value)) | ((F.col(key) == F.lit(value)) & inside)
    return inside


def _cuts_or_numbered(
    df: DataFrame, keys: list[str], wanted: list[tuple], group: Column, limits: dict
):
    """Cuts by the keys; if they tie, number the rows of a written copy as well."""
    wanted = sorted({w for w in wanted if w[1] > 0}, key=repr)
    if not wanted:
        return df, keys, {}
    try:
        return df, keys, rank_cuts(df, keys, wanted, group, limits)
    except TiedRank:
        # The numbers are written with the rows, so they hold from here on.
        df = cut_lineage(df.withColumn("_number", F.monotonically_increasing_id()))
        keys = [*keys, "_number"]
        return df, keys, rank_cuts(df, keys, wanted, group, limits)


def positional_split(df: DataFrame, order: Sequence[str], fraction: float) -> DataFrame:
    """Add ``part``: "initial" for the first ``int(n * fraction)`` rows, else "incoming"."""
    columns = df.columns
    limits = key_limits(df, order[0], F.lit(0))
    first = int(limits[0].n * fraction) if limits else 0
    df, keys, cuts = _cuts_or_numbered(df, list(order), [(0, first)], F.lit(0), limits)
    inside = _up_to(keys, cuts[0, first]) if first else F.lit(False)
    part = F.when(inside, "initial").otherwise("incoming")
    return df.select(*columns, part.alias("part"))


def _kept_per_class(counts: dict, keep: int) -> dict:
    """Share ``keep`` rows over the classes in proportion, by largest remainder."""
    total = sum(counts.values())
    shares = {c: divmod(n * keep, total) for c, n in counts.items()}
    kept = {c: whole for c, (whole, _) in shares.items()}
    spare = keep - sum(kept.values())
    by_remainder = sorted(counts, key=lambda c: (-shares[c][1], c))
    for c in by_remainder[:spare]:
        kept[c] += 1
    return kept


def split_sizes(counts: dict, test_size: float, val_size: float) -> dict:
    """Rows of each class going to (test, val, train).

    Test is cut first, then validation from the rest; both sizes round up and
    training keeps what is left.
    """
    total = sum(counts.values())
    n_test = math.ceil(test_size * total)
    rest = _kept_per_class(counts, total - n_test)
    n_val = math.ceil(val_size / (1 - test_size) * (total - n_test))
    train = _kept_per_class(rest, total - n_test - n_val)
    return {c: (counts[c] - rest[c], rest[c] - train[c], train[c]) for c in counts}


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    test_size: float = 0.15,
    val_size: float = 0.15,
    seed: int = 42,
    order: Column | None = None,
) -> DataFrame:
    """Add ``split`` (train, val or test) with exact sizes per class.

    Within a class rows are taken in the order of a seeded hash of ``key`` (or
    of the integer ``order``): membership depends on the row alone, so it is
    the same however the table is partitioned or recomputed.
    """
    columns = df.columns
    hashed = F.xxhash64(F.lit(seed), F.col(key)) if order is None else order
    ordered = df.withColumns({"_order": hashed, "_tie": F.xxhash64(F.lit(seed + 1), F.col(key))})
    limits = key_limits(ordered, "_order", F.col(label))
    if None in limits:
        raise ValueError(f"rows without {label} cannot be stratified")
    sizes = split_sizes({c: found.n for c, found in limits.items()}, test_size, val_size)
    wanted = [(c, k) for c, (test, val, _) in sizes.items() for k in (test, test + val)]
    ordered, keys, cuts = _cuts_or_numbered(
        ordered, ["_order", "_tie"], wanted, F.col(label), limits
    )
    split = F.lit("train")
    for c, (test, val, _) in sizes.items():
        of_class = F.col(label) == F.lit(c)
        if test + val:
            split = F.when(of_class & _up_to(keys, cuts[c, test + val]), "val").otherwise(split)
    for c, (test, _, _) in sizes.items():
        of_class = F.col(label) == F.lit(c)
        if test:
            split = F.when(of_class & _up_to(keys, cuts[c, test]), "test").otherwise(split)
    return ordered.select(*columns, split.alias("split"))


def latest_batch(df: DataFrame, batch: str) -> DataFrame:
    """The rows of the greatest ``batch``; rows without one are in none.

    The number is looked up in that column alone, and file statistics skip older batches.
    """
    newest = df.agg(F.max(batch)).first()[0]
    return df.where(F.col(batch) == F.lit(newest)) if newest is not None else df.limit(0)


def recent_rows(df: DataFrame, order: Sequence[str], n: int = 400) -> DataFrame:
    """The last ``n`` rows of the order.

    The place of the n-th last row is looked up in the order columns alone; the
    other columns are then read from there on only, which file statistics turn
    into skipped row groups.
    """
    newest_first = [F.desc(c) for c in order]
    keys = df.select(*order).orderBy(*newest_first).limit(n)
    oldest = tuple(keys.orderBy(*order).first() or ())
    if oldest and None not in oldest:
        later = F.col(order[-1]) >= F.lit(oldest[-1])
        for name, value in list(zip(order, oldest))[:-1][::-1]:
            column, at = F.col(name), F.lit(value)
            later = (column >= at) & ((column > at) | later)
        df = df.where(later)
    return df.orderBy(*newest_first).limit(n)
