"""Removal of repeated byte strings by common-prefix intervals of suffix arrays.

Every string of ``width`` bytes that starts at two places of the corpus is
covered. A suffix array of a corpus does not fit a task, so it is built for the
parts whose strings can be equal:

1. Each window of ``width`` bytes has an anchor, the least hash of its 32-byte
   parts. Equal windows have equal anchors, so windows of different anchors never
   meet. Runs of windows with one anchor are kept as (anchor, place).
2. Runs whose anchor occurs once in the corpus hold no repeat. The others are cut
   out of their texts as segments, and equal segments are merged: a segment that
   occurs twice is repeated as a whole.
3. The distinct segments of an anchor go to one task, which sorts their suffixes,
   scans the common-prefix intervals with a stack, and reports each interval of at
   least ``width`` bytes whose suffixes differ in the byte before them: the maximal
   repeats, with all occurrences. Together they cover every repeated window.
   An anchor with very many distinct segments, such as where a very common passage
   begins, is spread by the windows themselves, which are counted by two 64-bit
   hashes; that path covers the same windows.
4. Covered ranges go back to the places of the segments and are cut out.

Equal texts are handled once; all their windows are repeated by definition.

Nulls: a null text is an empty one, a null doc_id is passed on. Repeated rows are
copies of each other and lose every window. Texts shorter than ``width`` bytes lose
nothing. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_or_empty, written

_PART = 32
_CHUNK = 1 << 20
_RUN = 224
_BUSY = 2048
_TASK_BYTES = 1 << 20
#: Ranks must stay below 2**21: a chunk, then 2048 segments of at most 423 bytes, do.
_MOST_SYMBOLS = (1 << 21) - 4096
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_C = np.uint64(0xFF51AFD7ED558CCD)
_SHIFT = np.uint64(32)


def _text_key() -> list[Column]:
    """128 bits that name a text."""
    text = text_or_empty()
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def _sliding(values: np.ndarray, size: int, best) -> np.ndarray:
    """The best of each ``size`` values in a row, from running bests of blocks."""
    n = len(values) - size + 1
    blocks = -(-len(values) // size)
    padded = np.empty(blocks * size, values.dtype)
    padded[: len(values)] = values
    padded[len(values) :] = values[-1]
    table = padded.reshape(blocks, size)
    ahead = best.accumulate(table, axis=1).ravel()
    behind = best.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[:n], ahead[size - 1 : size - 1 + n])


def _part_hashes(data: bytes) -> np.ndarray:
    """Hashes of all parts, from those of eight bytes by doubling."""
    size = 8
    values = np.ndarray((len(data) - size + 1,), "<u8", data, 0, (1,))
    while size < _PART:
        values = (values[:-size] * _A) ^ (values[size:] * _B)
        values ^= values >> _SHIFT
        values *= _C
        size *= 2
    return values ^ (values >> _SHIFT)


def anchor_runs(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """anchor, first window, windows and weight of each run of one text.

    A run has weight 2 if its anchor occurs twice in a row, as it may then repeat
    within itself.
    """
    out = []
    for at in range(0, max(0, len(data) - width + 1), _CHUNK):
        part = data[at : at + _CHUNK + width - 1]
        hashes = _part_hashes(part)
        size = width - _PART + 1
        least = _sliding(hashes, size, np.minimum)
        turn = np.flatnonzero(least[1:] != least[:-1]) + 1
        starts = np.concatenate([[0], turn])
        counts = np.diff(np.concatenate([starts, [len(least)]]))
        pieces = -(-counts // _RUN)
        if (pieces > 1).any():
            inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            whole = np.repeat(counts, pieces)
            starts = np.repeat(starts, pieces) + inner * _RUN
            counts = np.minimum(_RUN, whole - inner * _RUN)
        anchors = least[starts]
        # A part is the least of some window if the greatest least around it is its own.
        edge = np.zeros(size - 1, np.uint64)
        around = _sliding(np.concatenate([edge, least, edge]), size, np.maximum)
        least_parts = hashes[around == hashes]
        twice = least_parts[1:][least_parts[1:] == least_parts[:-1]]
        weights = np.ones(len(starts), np.int8) + np.isin(anchors, twice)
        out.append((anchors.view(np.int64), at + starts, counts, weights))
    if not out:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out))


def _anchors(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            found, sizes = [], []
            for body in part.column(2):
                data = body.as_py()
                sizes.append(len(data))
                found.append(anchor_runs(data, width))
            offsets = pa.array(np.cumsum([0] + [len(f[0]) for f in found]), pa.int32())
            lists = [
                pa.ListArray.from_arrays(
                    offsets, pa.array(np.concatenate([f[k] for f in found]).astype(kind))
                )
                for k, kind in enumerate((np.int64, np.int64, np.int32, np.int32))
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(sizes, pa.int64()), *lists],
                ["t1", "t2", "n_bytes", "anchor", "first", "windows", "weight"],
            )


_CUT = pa.schema(
    [("anchor", pa.int64()), ("tid", pa.int64()), ("first", pa.int64()), ("segment", pa.binary())]
)


def _cut(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [[], [], [], []]
        held = 0
        for tid, body, runs in zip(*batch.columns):
            data, tid = body.as_py(), tid.as_py()
            for run in runs.as_py():
                first = run["first"]
                segment = data[first : first + run["windows"] + width - 1]
                for column, value in zip(columns, (run["anchor"], tid, first, segment)):
                    column.append(value)
                held += len(segment) + 64
            if held > _TASK_BYTES:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _CUT.types)], schema=_CUT
                )
                columns, held = [[], [], [], []], 0
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _CUT.types)], schema=_CUT
            )


class SuffixArray:
    """Suffixes of joined segments that have ``width`` bytes left, in order.

    ``starts`` are their places, ``shared`` the common prefix of each with the one
    before, ``before`` the symbol to their left (0 at a segment's start), ``left``
    the bytes to their segment's end.
    """

    def __init__(self, segments: list[bytes], width: int) -> None:
        joined = np.zeros(sum(map(len, segments)) + len(segments) + 8, np.int64)
        lengths = np.array([len(s) for s in segments])
        self.base = np.cumsum(lengths + 1) - lengths
        body = np.frombuffer(b"".join(segments), np.uint8).astype(np.int64) + 1
        owner = np.repeat(np.arange(len(segments)), lengths)
        places = np.arange(len(body)) + owner + 1
        joined[places] = body
        end = np.zeros(len(joined), np.int64)
        end[places] = (self.base + lengths)[owner]
        self.size = len(joined)
        n = len(joined) - 7
        key = joined[:n].copy()
        for k in range(1, 7):
            key = (key << 9) | joined[k : n + k]
        ranks, step = [], 7
        while True:
            order = np.argsort(key)
            rank = np.empty(n, np.int32)
            ordered = key[order]
            rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            ranks.append((step, rank))
            if step >= lengths.max():
                break
            # Three ranks of fewer than 2**21 values each make the key of a triple step.
            key = rank.astype(np.int64) << 42
            for k in (1, 2):
                if k * step < n:
                    key[: n - k * step] += (rank[k * step :].astype(np.int64) + 1) << (42 - 21 * k)
            step *= 3
        wanted = places[end[places] - places >= width]
        self.starts = wanted[np.argsort(ranks[-1][1][wanted], kind="stable")]
        self.left = end[self.starts] - self.starts
        self.before = joined[self.starts - 1]
        self.segment = np.searchsorted(self.base, self.starts, "right") - 1
        a, b = self.starts[:-1].copy(), self.starts[1:].copy()
        shared = np.zeros(len(a), np.int64)
        for step, rank in [x for x in reversed(ranks) for _ in range(2)]:
            inside = (a < n) & (b < n)
            equal = np.zeros(len(a), bool)
            equal[inside] = rank[a[inside]] == rank[b[inside]]
            shared += step * equal
            a, b = a + step * equal, b + step * equal
        # The last few symbols change nothing that is at least ``width`` long but its end.
        for _ in range(6):
            inside = (a < len(joined)) & (b < len(joined))
            equal = np.zeros(len(a), bool)
            equal[inside] = joined[a[inside]] == joined[b[inside]]
            shared += equal
            a, b = a + equal, b + equal
            if not equal.any():
                break
        self.shared = np.concatenate([[0], shared]) if len(self.starts) else shared


def maximal_repeats(suffixes: SuffixArray, width: int) -> Iterator[tuple[int, int, int]]:
    """(first suffix, last suffix, length) of every maximal repeat group.

    The stack holds the open common-prefix intervals and whether two of their
    suffixes have different symbols to the left; an interval that has is maximal,
    as the group cannot be extended by one symbol on either side.
    """
    shared = suffixes.shared
    inside = shared >= width
    edges = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(edges == 1) - 1, np.flatnonzero(edges == -1) - 1
    before = suffixes.before
    pair = ends - begins == 1
    first, last = begins[pair], ends[pair]
    diverse = (before[first] != before[last]) | (before[first] == 0)
    yield from zip(
        first[diverse].tolist(), last[diverse].tolist(), shared[last[diverse]].tolist()
    )
    for begin, end in zip(begins[~pair].tolist(), ends[~pair].tolist()):
        symbols = before[begin : end + 1].tolist()
        lengths = shared[begin + 1 : end + 1].tolist() + [0]
        # Each entry: common length, first suffix, left symbol or -1 if diverse.
        stack: list[list[int]] = []
        for i, length in enumerate(lengths):
            at, symbol = i, symbols[i] or -1
            while stack and stack[-1][0] > length:
                top, at, inner = stack.pop()
                symbol = inner if inner == symbol else -1
                if symbol < 0:
                    yield begin + at, begin + i, top
            if length < width:
                continue
            if stack and stack[-1][0] == length:
                if stack[-1][2] != symbol:
                    stack[-1][2] = -1
            else:
                stack.append([length, at, symbol])


def covered(segments: list[bytes], width: int) -> dict[int, list[tuple[int, int]]]:
    """Ranges of each segment that a repeat among them covers, merged."""
    suffixes = SuffixArray(segments, width)
    opened = np.zeros(suffixes.size + 1, np.int32)
    for first, last, length in maximal_repeats(suffixes, width):
        starts = suffixes.starts[first : last + 1]
        opened[starts] += 1
        np.subtract.at(opened, starts + np.minimum(length, suffixes.left[first : last + 1]), 1)
    inside = (np.cumsum(opened) > 0).astype(np.int8)
    edges = np.diff(np.concatenate([[0], inside, [0]]))
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    owner = np.searchsorted(suffixes.base, begin, "right") - 1
    base = suffixes.base[owner]
    out: dict[int, list[tuple[int, int]]] = {}
    for k, a, b in zip(owner.tolist(), (begin - base).tolist(), (end - base).tolist()):
        out.setdefault(k, []).append((a, b))
    return out


_RANGES = pa.schema(
    [
        ("s1", pa.int64()),
        ("s2", pa.int64()),
        ("ranges", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
    ]
)
_RANGES_SQL = "s1 long, s2 long, ranges array<struct<a: long, b: long>>"


def _scan(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Handle whole anchors, several at once, of rows sorted by anchor."""

    def found(rows: list[tuple]) -> pa.RecordBatch:
        ranges = covered([r[3] for r in rows], width)
        hits = sorted(ranges)
        columns = [
            [rows[k][1] for k in hits],
            [rows[k][2] for k in hits],
            [[{"a": a, "b": b} for a, b in ranges[k]] for k in hits],
        ]
        arrays = [pa.array(c, t) for c, t in zip(columns, _RANGES.types)]
        return pa.RecordBatch.from_arrays(arrays, schema=_RANGES)

    rows, held = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held > _TASK_BYTES and row[0] != rows[-1][0]:
                yield found(rows)
                rows, held = [], 0
            if rows and held + len(row[3]) > _MOST_SYMBOLS:
                raise ValueError("an anchor has more segments than a task's suffix array can hold")
            rows.append(row)
            held += len(row[3]) + 1
    if rows:
        yield found(rows)


def window_hashes(segment: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each window, by polynomials in odd bases."""
    body = np.frombuffer(segment, np.uint8).astype(np.uint64) + np.uint64(1)
    out = []
    for base in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        mixed = (body * np.uint64(base)) ^ ((body * _B) >> np.uint64(29))
        powers = np.cumprod(np.full(len(body), base, np.uint64))
        inverse = np.cumprod(np.full(len(body), pow(base, -1, 1 << 64), np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed * powers)])
        values = (sums[width:] - sums[:-width]) * inverse[: len(body) - width + 1]
        out.append((values ^ (values >> _SHIFT)).view(np.int64))
    return out[0], out[1]


def _windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            rows = []
            for s1, s2, segment in zip(*(c.to_pylist() for c in part.columns)):
                w1, w2 = window_hashes(segment, width)
                rows.append((np.full(len(w1), s1), np.full(len(w1), s2), np.arange(len(w1)), w1, w2))
            if rows:
                columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, ["s1", "s2", "at", "w1", "w2"])


def _busy_ranges(segments: DataFrame, width: int) -> DataFrame:
    """Ranges of segments of busy anchors, from counts of single windows."""
    windows = segments.select("s1", "s2", "segment").mapInArrow(
        lambda b: _windows(b, width), "s1 long, s2 long, at long, w1 long, w2 long"
    )
    again = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hit = windows.join(again, ["w1", "w2"])
    one = F.struct(F.col("at").alias("a"), (F.col("at") + width).alias("b"))
    return hit.groupBy("s1", "s2").agg(F.sort_array(F.collect_list(one)).alias("ranges"))


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for t1, t2, body, ranges in batch.itertuples(index=False, name=None):
            body, spans = bytes(body), _joined([(r["a"], r["b"]) for r in ranges])
            digest, at = hashlib.sha256(), 0
            for a, b in spans:
                digest.update(body[at:a])
                at = b
            digest.update(body[at:])
            rows.append((t1, t2, sum(b - a for a, b in spans), len(spans), digest.hexdigest()))
        yield pd.DataFrame(rows, columns=["t1", "t2", "n_removed", "n_spans", "kept_sha256"])


def repeated_ranges(docs: DataFrame, width: int = 200, busy: int = _BUSY):
    """What the other texts repeat: (texts with t1, t2, copies, n_bytes), (cut texts).

    The second has t1, t2, body and ``ranges``, byte ranges that may overlap.
    """
    text = text_or_empty()
    runs = docs.select(*_text_key(), text.cast("binary").alias("body")).mapInArrow(
        lambda b: _anchors(b, width),
        "t1 long, t2 long, n_bytes long, anchor array<long>, first array<long>, "
        "windows array<int>, weight array<int>",
    )
    names = ("n_bytes", "anchor", "first", "windows", "weight")
    texts = runs.groupBy("t1", "t2").agg(
        *[F.first(n).alias(n) for n in names], F.count("*").alias("copies")
    )
    texts = written(texts.withColumn("tid", F.monotonically_increasing_id()), "runs")
    zipped = F.arrays_zip("anchor", "first", "windows", "weight")
    places = texts.select("tid", F.explode(zipped).alias("run")).select("tid", "run.*")
    shared = (
        places.groupBy(F.col("anchor").alias("shared"))
        .agg(F.sum("weight").alias("n"))
        .where("n > 1")
        .select("shared")
    )
    wanted = (
        places.join(shared, F.col("anchor") == F.col("shared"))
        .groupBy("tid")
        .agg(F.collect_list(F.struct("anchor", "first", "windows")).alias("runs"))
    )
    wanted = texts.select("tid", "t1", "t2").join(wanted, "tid")
    bodies = (
        docs.select(*_text_key(), text.alias("text"))
        .where(F.octet_length("text") >= width)
        .groupBy("t1", "t2")
        .agg(F.first("text").alias("text"))
    )
    bodies = written(
        bodies.join(wanted, ["t1", "t2"]).select(
            "t1", "t2", "tid", F.col("text").cast("binary").alias("body"), "runs"
        ),
        "bodies",
    )
    cut = bodies.select("tid", "body", "runs").mapInArrow(
        lambda b: _cut(b, width), "anchor long, tid long, first long, segment binary"
    )
    cut = written(
        cut.select(
            "anchor",
            "tid",
            "first",
            "segment",
            F.xxhash64("anchor", "segment").alias("s1"),
            F.xxhash64(F.lit(1), "anchor", "segment").alias("s2"),
        ),
        "segments",
    )
    segments = cut.groupBy("s1", "s2").agg(
        F.first("anchor").alias("anchor"),
        F.first("segment").alias("segment"),
        F.octet_length(F.first("segment")).cast("long").alias("size"),
        F.count("*").alias("copies"),
    )
    segments = written(segments, "distinct")
    crowds = written(
        segments.groupBy(F.col("anchor").alias("crowd"))
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > busy)
        .select("crowd"),
        "crowds",
    )
    on = F.col("anchor") == F.col("crowd")
    few = segments.join(crowds, on, "left_anti").select("anchor", "s1", "s2", "segment")
    many = segments.join(crowds, on, "left_semi")
    scanned = (
        few.repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(lambda b: _scan(b, width), _RANGES_SQL)
    )
    whole = segments.where("copies > 1").select(
        "s1", "s2", F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("size").alias("b"))).alias("ranges")
    )
    ranges = scanned.unionByName(_busy_ranges(many, width)).unionByName(whole)
    placed = cut.select("tid", "first", "s1", "s2").join(ranges, ["s1", "s2"])
    moved = F.transform(
        "ranges",
        lambda r: F.struct((r["a"] + F.col("first")).alias("a"), (r["b"] + F.col("first")).alias("b")),
    )
    per_text = (
        placed.select("tid", moved.alias("ranges"))
        .groupBy("tid")
        .agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    )
    return texts.select("t1", "t2", "copies", "n_bytes"), bodies.select(
        "tid", "t1", "t2", "body"
    ).join(per_text, "tid").select("t1", "t2", "body", "ranges")


def without_repeats(docs: DataFrame, width: int = 200, busy: int = _BUSY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    docs = docs.select("doc_id", "text")
    texts, hits = repeated_ranges(docs, width, busy)
    copied = texts.where((F.col("copies") > 1) & (F.col("n_bytes") >= width))
    removed = hits.join(copied.select("t1", "t2"), ["t1", "t2"], "left_anti").mapInPandas(
        _remove, "t1 long, t2 long, n_removed long, n_spans long, kept_sha256 string"
    )
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    everything = copied.select(
        "t1", "t2", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        nothing.alias("kept_sha256"),
    )
    changed = removed.unionByName(everything)
    text = text_or_empty()
    rows = docs.select(
        "doc_id",
        *_text_key(),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("sha256"),
    )
    return rows.join(changed, ["t1", "t2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )
