"""Lloyd's clustering with vectors and centroids cut into blocks of dimensions.

A vector's components become integers, so all sums are exact and a run gives the same
clusters on any cluster. Vectors are stored as cells: the components of one block of
dimensions for a few hundred vectors (a chunk). A round is one job:

1. A task that reads a block's cells computes exact partial squared distances of each
   vector to the centroids' slices of that block alone.
2. The cells of a chunk meet, their partial distances are added (a reduce by chunk)
   and each vector takes the nearest centroid, ties the smaller number.
3. Each block's components are summed by cluster within the task, the sums are reduced by
   block, and every shard divides its own slice.

Only slices (clusters x dimensions numbers) pass through the driver. No chunk or block
grows with the data or with a cluster's size: chunks are cut by place, cluster sums are
combined in each task first, so a cluster with a third of all vectors is no hot group.

Nulls and odd rows: a vector that is null, has another number of components, or a null
or non-finite one (also after scaling) is left out. A null id is kept; it draws like
an empty one. Repeated rows count each. Fewer vectors than clusters: as many clusters as
vectors; an empty table gives no rows. Integers too large for exact 64-bit arithmetic go
through unbounded ones; a distance, or a sum of them, beyond a long is null.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written

_CHUNK = 256
_LONG = 1 << 62


def packed(values: np.ndarray) -> bytes:
    """An array of whole numbers; small ones as byte planes, which compress well."""
    if values.dtype == object:
        return b"o" + pickle.dumps(values.tolist())
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    width = next((w for w in (1, 2, 4) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1), 8)
    planes = values.astype(f"<i{width}").reshape(-1).view(np.uint8).reshape(-1, width).T
    return b"%d" % width + planes.tobytes()


def unpacked(data: bytes, columns: int) -> np.ndarray:
    """The array with that many columns."""
    if data[:1] == b"o":
        return np.array(pickle.loads(data[1:]), object).reshape(-1, columns)
    width = int(data[:1])
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    flat = np.ascontiguousarray(planes.T).view(f"<i{width}").reshape(-1)
    return flat.astype(np.int64).reshape(-1, columns)


def exact(values: np.ndarray) -> np.ndarray:
    """Whole doubles as 64-bit integers, or as unbounded ones if squares could overflow."""
    if not values.size or np.abs(values).max() <= 1 << 24:
        return values.astype(np.int64)
    return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)


def partial_distances(cell: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``cell`` to each row of ``slices``, exact."""
    if cell.dtype == object or slices.dtype == object:
        cell, slices = cell.astype(object), slices.astype(object)
    elif cell.shape[1] * (np.abs(cell).max(initial=1) + np.abs(slices).max(initial=1)) ** 2 < 1 << 52:
        cell, slices = cell.astype(float), slices.astype(float)  # exact, and multiplied faster
    cross = cell @ slices.T
    found = (cell * cell).sum(axis=1)[:, None] - 2 * cross + (slices * slices).sum(axis=1)[None]
    return found if found.dtype == object else found.astype(np.int64)


def _vectors(rows: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the kept rows, and their scaled and floored components."""
    lengths = pc.fill_null(pc.list_value_length(rows), -1).to_numpy()
    right = np.flatnonzero(lengths == dims)
    flat = pc.list_flatten(rows.take(pa.array(right)))
    values = flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(values * scale)
    finite = np.isfinite(values).all(axis=1)
    return right[finite], values[finite]


def cells(vectors: DataFrame, dims: int, block: int, scale: int) -> DataFrame:
    """Rows (chunk, block, data, ids); ids stand in block 0, numbered by place."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 40
        for batch in batches:
            places, values = _vectors(batch.column("embedding"), dims, scale)
            ids = batch.column("vec_id").take(pa.array(places)).to_pylist()
            for at in range(0, len(places), _CHUNK):
                part = values[at : at + _CHUNK]
                blocks = range(0, dims, block)
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": [chunk] * len(blocks),
                        "block": list(range(len(blocks))),
                        "data": [packed(exact(part[:, b : b + block])) for b in blocks],
                        "ids": [ids[at : at + _CHUNK], *[None] * (len(blocks) - 1)],
                    },
                    schema=_CELLS,
                )
                chunk += 1

    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).mapInArrow(cut, "chunk long, block int, data binary, ids array<long>")


_CELLS = pa.schema(
    [("chunk", pa.int64()), ("block", pa.int32()), ("data", pa.binary()), ("ids", pa.list_(pa.int64()))]
)


def first_centroids(vectors: DataFrame, clusters: int, dims: int, scale: int, seed: str) -> np.ndarray:
    """The kept vectors of the ``clusters`` smallest digests, in their order."""
    x = F.transform("embedding", lambda v: v.cast("double") * scale)
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = vectors.where((F.size("embedding") == dims) & finite)
    rows = kept.select(digest.alias("d"), x.alias("x")).orderBy("d", "x").limit(clusters).collect()
    return exact(np.floor(np.array([r.x for r in rows], float).reshape(-1, dims)))


def _cut(centroids: np.ndarray, block: int) -> list[np.ndarray]:
    return [centroids[:, b : b + block] for b in range(0, centroids.shape[1], block)]


def with_partials(stored: DataFrame, centroids: np.ndarray, block: int) -> DataFrame:
    """Each cell with its partial distances to its block's slices."""
    slices = _cut(centroids, block)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                mine = slices[one.column("block")[0].as_py()]
                cell = unpacked(one.column("data")[0].as_py(), mine.shape[1])
                found = pa.array([packed(partial_distances(cell, mine))], pa.binary())
                yield pa.RecordBatch.from_arrays([*one.columns, found], [*one.schema.names, "partial"])

    return stored.mapInArrow(measure, "chunk long, block int, data binary, ids array<long>, partial binary")


def nearest(group: pa.Table, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    """Adds the blocks of a chunk; each vector's centroid and distance."""
    total = 0
    for data in group.column("partial"):
        total = total + unpacked(data.as_py(), clusters)
    best = np.array([min(range(clusters), key=row.__getitem__) for row in total]) if total.dtype == object else total.argmin(axis=1)
    return best, total[np.arange(len(best)), best]


def new_slices(measured: DataFrame, centroids: np.ndarray, block: int) -> list[np.ndarray]:
    """The slice of each block after one update."""
    clusters, old = len(centroids), _cut(centroids, block)
    widths = [s.shape[1] for s in old]

    def tally(group: pa.Table) -> pa.Table:
        best, _ = nearest(group, clusters)
        counts = np.bincount(best, minlength=clusters)
        sums = []
        for b, data in zip(group.column("block").to_pylist(), group.column("data")):
            cell = unpacked(data.as_py(), widths[b])
            total = np.zeros((clusters, widths[b]), cell.dtype)
            np.add.at(total, best, cell)
            sums.append(packed(total))
        return pa.table({"block": group.column("block"), "sums": pa.array(sums, pa.binary()), "counts": pa.array([packed(counts)] * len(sums), pa.binary())})

    def added(groups) -> dict[int, list]:
        totals: dict[int, list] = {}
        for b, sums, counts in groups:
            one = [unpacked(sums, widths[b]).astype(object), unpacked(counts, 1).astype(object)]
            totals[b] = [x + y for x, y in zip(totals[b], one)] if b in totals else one
        return totals

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (zip(*(c.to_pylist() for c in batch.columns)) for batch in batches)
        for b, (sums, counts) in added(r for part in rows for r in part).items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "sums": [packed(_small(sums))], "counts": [packed(_small(counts))]})

    def divided(group: pa.Table) -> pa.Table:
        ((b, (sums, counts)),) = added(zip(*(c.to_pylist() for c in group.columns))).items()
        moved = [s // n if n else o for s, n, o in zip(sums, counts[:, 0], old[b].astype(object))]
        return pa.table({"block": pa.array([b], pa.int32()), "slice": [packed(_small(np.array(moved, object)))]})

    shape = "block int, sums binary, counts binary"
    tallied = measured.groupBy("chunk").applyInArrow(tally, shape).mapInArrow(combined, shape)
    rows = tallied.groupBy("block").applyInArrow(divided, "block int, slice binary").collect()
    found = {r.block: unpacked(bytes(r.slice), widths[r.block]) for r in rows}
    return [found[b] for b in range(len(widths))]


def _small(values: np.ndarray) -> np.ndarray:
    """Unbounded integers as 64-bit ones where they fit."""
    return values.astype(np.int64) if all(abs(v) < _LONG for v in values.ravel()) else values


def _joined(slices: list[np.ndarray]) -> np.ndarray:
    whole = np.concatenate([s.astype(object) for s in slices], axis=1)
    return whole.astype(np.int64) if all(abs(v) <= 1 << 24 for v in whole.ravel()) else whole


def clustered(
    vectors: DataFrame,
    clusters: int = 40,
    rounds: int = 5,
    dims: int = 64,
    block: int = 16,
    scale: int = 256,
    seed: str = "2:",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept row.

    ``vectors`` has vec_id and embedding; ``clusters`` x ``dims`` numbers must fit into
    the driver and a task.
    """
    stored = written(cells(vectors, dims, block, scale), "cells")
    centroids = first_centroids(vectors, clusters, dims, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _joined(new_slices(with_partials(stored, centroids, block), centroids, block))
    k = len(centroids)

    def assign(group: pa.Table) -> pa.Table:
        best, distance = nearest(group, k)
        (ids,) = (x for x in group.column("ids").to_pylist() if x is not None)
        distance = [d if d < 1 << 63 else None for d in distance.tolist()]
        return pa.table(
            {"vec_id": pa.array(ids, pa.int64()), "cluster": pa.array(best, pa.int32()), "distance": pa.array(distance, pa.int64())}
        )

    measured = with_partials(stored, centroids, block) if k else stored.withColumn("partial", F.lit(None).cast("binary"))
    assigned = measured.groupBy("chunk").applyInArrow(assign, "vec_id long, cluster int, distance long")
    rows = written(assigned, "clusters")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    named = vectors.sparkSession.createDataFrame(list(enumerate(digests)), "number int, centroid_sha256 string")
    # One row per cluster, whatever the number of vectors.
    sums = rows.groupBy(F.col("cluster").alias("number")).agg(_total(F.col("distance")).alias("part"))
    whole = sums.agg(_total(F.col("part")).alias("whole"))
    return rows.join(F.broadcast(named.join(sums, "number")), F.col("cluster") == F.col("number")).select(
        "vec_id",
        "cluster",
        "distance",
        F.col("part").try_cast("long").alias("cluster_inertia"),
        whole.scalar().try_cast("long").alias("inertia"),
        "centroid_sha256",
    )


def _total(value: Column) -> Column:
    """An exact sum; null if any value is."""
    total = F.sum(value.cast("decimal(38,0)"))
    return F.when(F.count(value) == F.count("*"), total)
