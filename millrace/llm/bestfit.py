"""Packing documents into few sequences by bounded-space online best-fit.

Documents come as they are stored. Only one longer than a sequence is cut, into full
sequences and a rest. A task keeps a fixed number of bins open; a bitset holds a 1 at
every free space that an open bin has, so the bin that fits best is the lowest bit at or
above the piece's length. If none fits, the fullest open bin closes for good and a new
one opens. Memory is that of the open bins, whatever the number of documents.

Every scan task packs its own rows, texts are never shuffled. The bins still open at the end
of a task are, as wholes, pieces of a second run of the same method over far fewer
tasks, which joins half-empty bins of different tasks.

Nulls: a null text has only its end token, a null doc_id is passed on. Repeated
rows are packed once each; an empty table gives no pieces. Task retries pack alike.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import byte_characters, written

END_ID = 0
_KNOWN_WORDS = 300_000
_OUT_ROWS = 8_192
_JOINED_BINS = 1_000_000
_encoders: dict[str, Encoder] = {}


#: White space parts words, so a text may be encoded space by space. Pieces of these
#: characters need no normalising but lower case, and are letters, digits or neither alike
#: in all versions of Unicode.
_PLAIN = re.compile(r"[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
#: The splits that the tokenizer makes, for these characters in lower case.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \t-\r]+")


class Encoder:
    """Ids of a lower-case vocabulary with word ends ("</w>"), as its tokenizer file gives them.

    Words met before are remembered. New ones of plain characters are merged by a faster
    library: a byte is a character from U+0100 on, the last one of a word from U+0200 on,
    so that ends differ. Anything else goes through the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        special = {t["content"] for t in parsed["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        values, ranks = byte_characters(), {}
        for token, number in parsed["model"]["vocab"].items():
            if token not in special:
                body = [values[c] for c in token.removesuffix("</w>")]
                ranks[self._symbols(body, token.endswith("</w>")).encode()] = number
        self.merged = tiktoken.Encoding(
            "words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _symbols(body, ends: bool) -> str:
        characters = [chr(256 + b) for b in body]
        if ends:
            characters[-1] = chr(512 + body[-1])
        return "".join(characters)

    def _word(self, word: str) -> bytes:
        out = array("I", self.merged(self._symbols(word.encode(), True))).tobytes()
        if len(self.known) < _KNOWN_WORDS and len(word) < 64:
            self.known[word] = out
        return out

    def _plain(self, text: str) -> bytes:
        words, known = _WORDS.findall(text.lower()), self.known
        try:
            return b"".join([known[word] for word in words])
        except KeyError:
            return b"".join([known.get(word) or self._word(word) for word in words])

    def ids(self, text: str) -> bytes:
        """Unsigned 32-bit little-endian ids."""
        if _PLAIN.fullmatch(text) and not self.special.search(text):
            return self._plain(text)
        out = []
        for piece in text.split(" "):
            if _PLAIN.fullmatch(piece) and not self.special.search(piece):
                out.append(self._plain(piece))
            else:
                out.append(array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes())
        return b"".join(out)


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class OpenBins:
    """At most ``most`` open bins of ``size`` places, found by their free space."""

    def __init__(self, size: int, most: int) -> None:
        self.size, self.most, self.held = size, most, 0
        self.bits = 0
        self.by_free: dict[int, list[list]] = {}

    def _take(self, free: int) -> list:
        same = self.by_free[free]
        found = same.pop()
        if not same:
            self.bits ^= 1 << free
        self.held -= 1
        return found

    def put(self, item, length: int) -> list[list]:
        """Places an item; the bins that close by it, each a list of (item, offset)."""
        closed = []
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.held == self.most:
                closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            free, bin_ = self.size, []
        bin_.append((item, self.size - free))
        free -= length
        if not free:
            closed.append(bin_)
            return closed
        if not self.by_free.setdefault(free, []):
            self.bits |= 1 << free
        self.by_free[free].append(bin_)
        self.held += 1
        return closed

    def rest(self) -> Iterator[list]:
        """The bins still open, the fullest first."""
        while self.bits:
            yield self._take((self.bits & -self.bits).bit_length() - 1)


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("used", pa.int64()),
    ]
)
_SHAPE = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, used long"


def packed_by_task(texts: DataFrame, path: str, size: int, open_bins: int, end_id: int) -> DataFrame:
    """Pieces and their places; ``used`` is the fill of a bin left open, else null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(path), array("I", [end_id]).tobytes()
        bins, rows = OpenBins(size, open_bins), []
        number = TaskContext.get().partitionId() << 40

        def close(bin_: list, used: int | None = None) -> None:
            nonlocal number
            rows.extend((*item, number, offset, used) for item, offset in bin_)
            number += 1

        def full() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)
            rows.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = memoryview(coder.ids(text.as_py()) + end)
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    length = len(part) // 4
                    for bin_ in bins.put((doc_id, piece, at // 4, length, zlib.crc32(part)), length):
                        close(bin_)
                if len(rows) >= _OUT_ROWS:
                    yield full()
        for bin_ in bins.rest():
            (*_, length, _), offset = bin_[-1]
            close(bin_, offset + length)
        if rows:
            yield full()

    return texts.mapInArrow(run, _SHAPE)


def joined_bins(left: DataFrame, size: int, open_bins: int) -> DataFrame:
    """Bins (sequence_id, used) as items of fewer bins: where each goes and how far it moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(size, open_bins)

        def moves(found: list[list]) -> pa.RecordBatch:
            rows = [(item, bin_[0][0], offset) for bin_ in found for item, offset in bin_]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["old", "sequence_id", "moved"])

        for batch in batches:
            found = []
            for sequence, used in zip(*(c.to_pylist() for c in batch.columns)):
                found += bins.put(sequence, used)
            if found:
                yield moves(found)
        if bins.held:
            yield moves(list(bins.rest()))

    tasks = 1 + left.count() // _JOINED_BINS
    dealt = left.repartition(tasks, "sequence_id").sortWithinPartitions(F.desc("used"), "sequence_id")
    return dealt.mapInArrow(run, "old long, sequence_id long, moved long")


def pack(docs: DataFrame, path: str, size: int = 2048, open_bins: int = 256, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    ``path`` is a tokenizer file whose tokens never hold a space; ``end_id`` ends each
    document.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    pieces = written(packed_by_task(texts, path, size, open_bins, end_id), "pieces")
    opened = pieces.where("used is not null")
    left = opened.groupBy("sequence_id").agg(F.max("used").alias("used"))
    moves = written(joined_bins(left, size, open_bins), "moves").withColumnRenamed("sequence_id", "goes_to")
    moved = opened.join(moves, F.col("sequence_id") == F.col("old")).withColumns(
        {"sequence_id": F.col("goes_to"), "offset": F.col("offset") + F.col("moved")}
    )
    names = [n for n in _PIECES.names if n != "used"]
    return pieces.where("used is null").select(*names).unionByName(moved.select(*names))
