"""Importance resampling towards a target distribution, by bit-sliced aggregation.

A document's hashed word n-grams are counts of buckets, kept as bit planes: bit b of plane
j is bit j of the count of bucket b. The gains of the buckets (log ratios of target and
corpus, whole thousandths) are planes too, in two's complement. The sum of
count x gain over all buckets is then a sum of popcounts,

    sum over j, k of 2^j * w(k) * popcount(count plane j AND gain plane k),

with w(k) = 2^k, negative for the sign plane: exact integers without a product per
feature. Documents are drawn by weight plus Gumbel noise from a digest of their id, so a
draw without replacement is a sort, and reruns agree.

Corpus counts cover all documents: every task adds up its buckets, one row of counts per
task is summed. Gains are as many numbers as there are buckets. Ranks come from a range
sort with counts per partition; nothing passes through one task.

Nulls: a null text has no words; a null id draws like an empty one and loses ties. Repeated
rows count each and are ranked one after the other. An empty table gives no rows, an
empty target leaves all documents the gains of the corpus alone.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written

# Of lower-cased UTF-8: digits, letters and every byte of other characters.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BLOCK = 1 << 16
_PLANES = 1 << 9


def bucket_counts(text: str, buckets: int) -> tuple[int, np.ndarray]:
    """The number of words, and the features per bucket, of words and pairs of neighbours."""
    words = _WORD.findall(text.encode().lower())
    counts = np.zeros(buckets, np.int64)
    for at in range(0, len(words), _BLOCK):
        part = words[at : at + _BLOCK]
        ones = [crc32(w) for w in part]
        # A checksum goes on where that of the word before ended.
        after = words[at + 1 : at + _BLOCK + 1]
        twos = [crc32(b, crc32(b" ", a)) for a, b in zip(ones, after)]
        counts += np.bincount(np.array(ones + twos, np.int64) % buckets, minlength=buckets)
    return len(words), counts


def width_of(buckets: int) -> int:
    """64-bit words of a plane."""
    return -(-buckets // 64)


def planes_of(values: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes (bits x words) of whole numbers, in two's complement."""
    rows = np.zeros((bits, 8 * width_of(len(values))), np.uint8)
    for j in range(bits):
        plane = np.packbits(((values >> j) & 1).astype(np.uint8))
        rows[j, : len(plane)] = plane
    return rows.view(np.uint64)


def count_planes(counts: np.ndarray) -> np.ndarray:
    return planes_of(counts, int(counts.max(initial=0)).bit_length())


def gain_planes(gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Planes of signed gains and what a bit of each is worth."""
    bits = 1 + max(int(gains.max(initial=0)), -int(gains.min(initial=0))).bit_length()
    worth = np.left_shift(np.int64(1), np.arange(bits))
    worth[-1] = -worth[-1]
    return planes_of(gains, bits), worth


def plane_sums(planes: np.ndarray, gains: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """For each plane, the worth of the bits it shares with the gain planes."""
    total = np.zeros(len(planes), np.int64)
    for gain, one in zip(gains, worth):
        total += one * np.bitwise_count(planes & gain).sum(axis=1, dtype=np.int64)
    return total


_COUNTED = "doc_id long, n_words long, n_features long, planes binary, totals binary"
_COUNTED_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("planes", pa.binary()), ("totals", pa.binary())]
)


def counted(docs: DataFrame, buckets: int) -> DataFrame:
    """A row per document with its planes, and one row per task with its ``totals``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _PLANES):
                part = batch.slice(at, _PLANES)
                words, features, planes = [], [], []
                for text in part.column("text"):
                    n, counts = bucket_counts(text.as_py() or "", buckets)
                    totals += counts
                    words.append(n)
                    features.append(int(counts.sum()))
                    planes.append(count_planes(counts).tobytes())
                columns = [part.column("doc_id"), words, features, planes, [None] * len(words)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _COUNTED_ARROW)], schema=_COUNTED_ARROW)
        yield pa.RecordBatch.from_pylist([{"totals": totals.tobytes()}], schema=_COUNTED_ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _COUNTED)


def bucket_totals(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket of all texts; as many numbers as buckets."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for data in batch.column("totals"):
                totals += np.frombuffer(data.as_py(), np.int64)
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(totals[at])], ["bucket", "n"])

    parts = rows.where("totals is not null").select("totals").mapInArrow(spread, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to corpus, one count added to each bucket."""
    n, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    pairs = zip(corpus.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in pairs], np.int64)


def noise(doc_id: int | None, seed: str) -> int:
    """Gumbel noise in thousandths, from a digest of the id."""
    digest = hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def weighed(rows: DataFrame, gains: np.ndarray, seed: str) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document."""
    planes, worth = gain_planes(gains)
    wide = planes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = []
            for data, n in zip(batch.column("planes"), batch.column("n_features").to_pylist()):
                mine = np.frombuffer(data.as_py(), np.uint64).reshape(-1, wide)
                sums = plane_sums(mine, planes, worth).tolist()
                weights.append(sum(v << j for j, v in enumerate(sums)) // n if n else 0)
            ids = batch.column("doc_id").to_pylist()
            scores = [w + noise(i, seed) for i, w in zip(ids, weights)]
            kept = [batch.column(c) for c in ("doc_id", "n_words", "n_features")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(weights, pa.int64()), pa.array(scores, pa.int64())], ["doc_id", "n_words", "n_features", "weight", "score"])

    documents = rows.where("totals is null").select("doc_id", "n_words", "n_features", "planes")
    return documents.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    buckets: int = 10_000,
    seed: str = "7:",
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document.

    Of the documents with at least ``least_words`` words, ``percent`` of a hundred with
    the highest scores are drawn and ranked from 1; others have no rank. ``target``
    has a text column; both sides' n-grams count, repeats included.
    """
    rows = written(counted(docs, buckets), "planes")
    texts = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    gains = bucket_gains(bucket_totals(rows, buckets), bucket_totals(counted(texts, buckets), buckets))
    able = F.col("n_words") >= least_words
    order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "weight"]
    scores = written(weighed(rows, gains, seed), "scores")
    sorted_ = scores.withColumn("able", able).repartitionByRange(*order).sortWithinPartitions(*order)
    # The id holds the partition above its lowest 33 bits, and the place in it.
    placed = written(sorted_.withColumn("place", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.count_if("able").alias("able"))
    sizes = sizes.orderBy("part").collect()  # one row per shuffle partition
    drawn = sum(row.able for row in sizes) * percent // 100
    firsts = accumulate((row.n for row in sizes), initial=0)
    begins = docs.sparkSession.createDataFrame([(row.part, n) for row, n in zip(sizes, firsts)], "part long, before long")
    rank = F.col("before") + place + 1
    return placed.join(F.broadcast(begins), part == F.col("part")).select(
        "doc_id", "n_features", "weight", "score", F.when(F.col("able") & (rank <= drawn), rank).alias("rank")
    )
