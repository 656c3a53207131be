"""Packing token streams into training sequences by dynamic programming.

Documents keep their order. A task joins the tokens of its documents to a stream,
in blocks, and chooses the cuts of a block that cost least: a cut between
documents costs least, one after a sentence a little more, one elsewhere most, and
a sequence costs the padding it needs. A sequence whose length is a power of two is
not padded, any other is padded to full length. With the best cost B(j) of
packing the first j tokens,

    B(j) = cut(j) + min( min{B(i) + size - (j - i): j - size <= i < j},
                         min{B(j - 2^k)} )

where the first minimum moves along with j and is kept in a monotone queue.

Each scan task packs its own rows in the order in which they are stored, so texts
are never shuffled. Spark hands out the splits of files by size; sequences are
numbered by file name and place in the file instead, so a table that is written in
training order has its sequences numbered in that order, over any number of files. The
splits are numbered by a range sort and joined with the pieces, which are small rows.
Rows that are no file scan are numbered by partition. Task retries pack alike.

Nulls: a null text has only its end token, a null doc_id is passed on. Repeated
rows are packed once each; an empty table gives no sequences.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import byte_characters, numbered

END_ID = 1
_BLOCK_TOKENS = 1 << 20
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of a byte-level tokenizer file. The file's special tokens keep their ids in a text."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        plain = {t: n for t, n in parsed["model"]["vocab"].items() if t not in special}
        values = byte_characters()
        ranks = {bytes(values[c] for c in token): number for token, number in plain.items()}
        coder = tiktoken.Encoding(
            "corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        self.encode = lambda text: coder.encode_to_numpy(text, allowed_special="all")
        self.closes = np.zeros(max([*ranks.values(), *special.values()]) + 2, bool)
        for token, number in ranks.items():
            self.closes[number] = token[-1:] in b".!?\n"

    def ids(self, text: str) -> bytes:
        """Unsigned 32-bit little-endian ids."""
        return self.encode(text).tobytes()


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def choose_cuts(places: np.ndarray, costs: np.ndarray, size: int) -> list[int]:
    """Indexes into ``places`` at which to cut, the first and last included.

    ``places`` rises from 0 to the length of the stream in steps of at most ``size``.
    """
    n = len(places)
    powers = [1 << k for k in range(size.bit_length())]
    found = [np.searchsorted(places, places - p) for p in powers if p <= size]
    pairs = [
        (np.flatnonzero((places >= p) & (places[at] == places - p)), at)
        for p, at in zip(powers, found)
    ]
    exact: dict[int, list[int]] = {}
    for targets, at in pairs:
        for j, i in zip(targets.tolist(), at[targets].tolist()):
            exact.setdefault(j, []).append(i)
    where, cost = places.tolist(), costs.tolist()
    best, back = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, n):
        here = where[j]
        while where[queue[0][1]] < here - size:
            queue.popleft()
        value, i = queue[0]
        value += size - here
        for k in exact.get(j, ()):
            if best[k] < value:
                value, i = best[k], k
        value += cost[j]
        best[j], back[j] = value, i
        key = value + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def cut_places(ends: np.ndarray, closes: np.ndarray, prices: tuple, size: int):
    """Where a stream may be cut and at what cost; long stretches get extra places."""
    total = int(ends[-1])
    sentences = np.flatnonzero(closes[:total]) + 1
    places = np.unique(np.concatenate([[0], sentences, ends]))
    step = max(1, size // 128)
    gaps = np.diff(places)
    extra = [
        np.arange(places[i] + step, places[i + 1], step) for i in np.flatnonzero(gaps > 8 * step)
    ]
    places = np.unique(np.concatenate([places, *extra])) if extra else places
    document, sentence, inside = prices
    costs = np.full(len(places), float(inside))
    costs[np.searchsorted(places, sentences)] = sentence
    costs[np.searchsorted(places, ends)] = document
    costs[0] = 0.0
    return places, costs


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def packed_block(doc_ids: list, tokens: list[bytes], closes, size, prices, first: int):
    """The pieces of one block as a record batch, and the next free sequence number."""
    stream = np.frombuffer(b"".join(tokens), np.uint32)
    lengths = np.array([len(t) // 4 for t in tokens], np.int64)
    ends = np.cumsum(lengths)
    places, costs = cut_places(ends, closes[stream], prices, size)
    cuts = places[choose_cuts(places, costs, size)]
    edges = np.unique(np.concatenate([cuts, ends]))
    begin, stop = edges[:-1], edges[1:]
    doc = np.searchsorted(ends, begin, "right")
    window = np.searchsorted(cuts, begin, "right") - 1
    body = memoryview(stream).cast("B")
    checks = [zlib.crc32(body[4 * a : 4 * b]) for a, b in zip(begin.tolist(), stop.tolist())]
    ids = pa.array(doc_ids, pa.int64())
    columns = [
        ids.take(pa.array(doc)),
        pa.array(begin - (ends - lengths)[doc]),
        pa.array(stop - begin),
        pa.array(checks, pa.int64()),
        pa.array(lengths[doc]),
        pa.array(first + window),
        pa.array(begin - cuts[window]),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_PIECES), first + len(cuts) - 1


def pack(
    docs: DataFrame,
    path: str,
    size: int = 2048,
    prices: tuple[float, float, float] = (4.0, 8.0, 16.0),
) -> DataFrame:
    """The pieces of every document and their place in a sequence.

    ``size`` is a power of two; ``prices`` of a cut between documents, after a
    sentence and elsewhere are in tokens of padding.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")

    split = _split_columns(docs)
    scanned = bool(split)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *split,
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        end = array("I", [END_ID]).tobytes()
        number = 0 if scanned else TaskContext.get().partitionId() << 40
        doc_ids, tokens, held, now = [], [], 0, None

        def block() -> pa.RecordBatch:
            nonlocal number
            found, number = packed_block(doc_ids, tokens, coder.closes, size, prices, number)
            if now:
                for name, value in zip(_SPLIT, now):
                    found = found.append_column(name, pa.array([value] * found.num_rows))
            return found

        for batch in batches:
            for doc_id, text, *place in zip(*batch.columns):
                place = [p.as_py() for p in place]
                if (place and place != now) or held >= _BLOCK_TOKENS:
                    if tokens:
                        yield block()
                        doc_ids, tokens, held = [], [], 0
                    if place != now and place:
                        now, number = place, 0
                doc_ids.append(doc_id.as_py())
                tokens.append(coder.ids(text.as_py()) + end)
                held += len(tokens[-1]) // 4
        if tokens:
            yield block()

    names = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    if not split:
        return texts.mapInArrow(run, names)
    pieces = texts.mapInArrow(run, f"{names}, file string, block long")
    order = _numbered_splits(docs, split)
    found = pieces.join(order, (F.col("file") == F.col("of_file")) & (F.col("block") == F.col("of_block")))
    sequence = F.shiftleft("number", 40) + F.col("sequence_id")
    return found.withColumn("sequence_id", sequence).select(*_PIECES.names)


_SPLIT = ("file", "block")


def _split_columns(docs: DataFrame) -> list:
    """File and place of the split a row is read from; none if rows are no file scan."""
    columns = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    try:
        docs.select(*columns).schema
    except AnalysisException:
        return []
    return columns


def _numbered_splits(docs: DataFrame, split: list) -> DataFrame:
    """The splits that hold rows, numbered by file name and place; reads no column."""
    # Runs of digits compare as numbers: part-100000 comes after part-99999.
    parts = F.split("file", r"(?<=\d)(?=\D)|(?<=\D)(?=\d)")
    by_number = F.transform(parts, lambda x: F.when(x.rlike(r"^\d"), F.lpad(x, 40, "0")).otherwise(x))
    rows = docs.select(*split).distinct().withColumn("by_number", by_number)
    order = numbered(rows, ["by_number", "block", "file"], "splits")
    return order.select(F.col("file").alias("of_file"), F.col("block").alias("of_block"), "number")
