"""Exact deduplication by Patricia tries that own groups of equal texts.

Texts are equal when identical after each run of white space is one space. Each
scan task first merges its own copies in a local trie, so that a text that makes
up a third of all rows crosses the network once per task, not once per row. Full
byte strings then go to partitions by length and content hash, where a compressed
radix trie holds them; its terminal nodes keep the smallest id and the number of
rows. A trie that outgrows its memory writes its heaviest subtree to a file of
the task and handles it on its own afterwards.

Nulls: a null text is an empty one; a null doc_id counts as larger than any id,
and where all ids of a group are null its rows all stay. Rows that repeat an id
and its text are one document: all stay in :func:`owned`, one in
:func:`deduplicated`. Empty tables give empty results.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import set_aside, text_or_empty

_LOCAL_BYTES = 24 << 20
_OWNER_BYTES = 96 << 20


def normalised(column: str = "text") -> Column:
    pattern = F.lit(r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]")
    return F.regexp_replace(text_or_empty(column), pattern, F.lit(" "))


class Node:
    __slots__ = ("edge", "children", "least", "ties", "rows")

    def __init__(self, edge: bytes) -> None:
        self.edge = edge
        self.children: dict[int, Node] = {}
        self.least: int | None = None
        self.ties = 0
        self.rows = 0

    def add(self, least: int | None, ties: int, rows: int) -> None:
        if self.rows == 0 or self.least == least:
            self.least, self.ties = least, self.ties + ties
        elif self.least is None or (least is not None and least < self.least):
            self.least, self.ties = least, ties
        self.rows += rows


def _shared(a: bytes, b: bytes, at: int) -> int:
    """How many bytes ``a`` shares with ``b`` from ``at`` on, by halving."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Patricia:
    """A radix trie of byte strings, compressed to one edge per run."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.held = 0
        self.strings = 0

    def insert(self, body: bytes, least: int | None, ties: int = 1, rows: int = 1) -> None:
        node, at, end = self.root, 0, len(body)
        while at < end:
            child = node.children.get(body[at])
            if child is None:
                child = node.children[body[at]] = Node(body[at:])
                self.held += end - at + 200
                at = end
            elif body.startswith(child.edge, at):
                at += len(child.edge)
            else:
                child = self._split(node, child, _shared(child.edge, body, at))
                at += len(child.edge)
            node = child
        self.strings += node.rows == 0
        node.add(least, ties, rows)

    def _split(self, parent: Node, child: Node, at: int) -> Node:
        upper = Node(child.edge[:at])
        child.edge = child.edge[at:]
        upper.children[child.edge[0]] = child
        parent.children[upper.edge[0]] = upper
        self.held += 200
        return upper

    def terminals(self, node: Node | None = None, before: bytes = b"") -> Iterator[tuple]:
        stack = [(node or self.root, before)]
        while stack:
            here, prefix = stack.pop()
            body = prefix + here.edge
            if here.rows:
                yield body, here.least, here.ties, here.rows
            stack += [(x, body) for x in here.children.values()]

    def take_heaviest(self) -> tuple[bytes, list[tuple]]:
        """Remove the largest subtree below the first fork: its prefix and strings."""
        node, prefix = self.root, b""
        while len(node.children) == 1 and not node.rows:
            node = next(iter(node.children.values()))
            prefix += node.edge
        if not node.children:
            return prefix, []
        sizes = {k: sum(len(t[0]) for t in self.terminals(x)) for k, x in node.children.items()}
        key = max(sizes, key=lambda k: (sizes[k], k))
        heaviest = node.children.pop(key)
        strings = list(self.terminals(heaviest, prefix))
        self.held -= min(self.held, sizes[key] + 200 * len(strings))
        self.strings -= len(strings)
        return prefix + heaviest.edge[:1], strings


def merged(rows: Iterator[tuple], limit: int = _OWNER_BYTES) -> Iterator[tuple]:
    """Each distinct string once with its smallest id, ties and rows, in bounded memory."""
    trie, spilled = Patricia(), {}
    for body, least, ties, count in rows:
        place = next((p for p in spilled if body.startswith(p)), None)
        if place is not None:
            pickle.dump((body, least, ties, count), spilled[place])
            continue
        trie.insert(body, least, ties, count)
        if trie.held > limit and trie.strings > 1:
            place, strings = trie.take_heaviest()
            if strings:
                spilled[place] = tempfile.TemporaryFile()
                for row in strings:
                    pickle.dump(row, spilled[place])
    yield from trie.terminals()
    for file in spilled.values():
        with file:
            file.seek(0)
            yield from merged(_loaded(file), limit)


def _loaded(file) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


_COPIES = pa.schema(
    [
        ("sha", pa.string()),
        ("length", pa.int64()),
        ("body", pa.binary()),
        ("least", pa.int64()),
        ("ties", pa.int64()),
        ("copies", pa.int64()),
    ]
)
_OWNERS = pa.schema(
    [
        ("owner_sha", pa.string()),
        ("keep_id", pa.int64()),
        ("owner_ties", pa.int64()),
        ("group_size", pa.int64()),
    ]
)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 8 << 20):
    """Record batches of bounded bytes."""
    held, taken = [], 0
    for row in rows:
        held.append(row)
        taken += 100 + sum(len(x) for x in row if isinstance(x, bytes))
        if taken > size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema
            )
            held, taken = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema
        )


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        trie, digests = Patricia(), {}
        for batch in batches:
            for doc_id, body, sha in zip(*batch.columns):
                body = body.as_py()
                trie.insert(body, doc_id.as_py())
                digests[body] = sha.as_py()
                if trie.held > _LOCAL_BYTES:
                    yield from emitted(trie, digests)
                    trie, digests = Patricia(), {}
        yield from emitted(trie, digests)

    def emitted(trie: Patricia, digests: dict[bytes, str]) -> Iterator[tuple]:
        for body, least, ties, count in trie.terminals():
            yield digests[body], len(body), body, least, ties, count

    yield from _batches(rows(), _COPIES)


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for row in zip(*batch.columns):
                yield tuple(x.as_py() for x in row)

    def owners() -> Iterator[tuple]:
        for body, least, ties, count in merged(rows()):
            yield hashlib.sha256(body).hexdigest(), least, ties, count

    yield from _batches(owners(), _OWNERS)


def owners(docs: DataFrame) -> DataFrame:
    """One row per distinct text: owner_sha, keep_id, owner_ties, group_size."""
    body = normalised()
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        body.cast("binary").alias("body"),
        F.sha2(body, 256).alias("sha"),
    )
    copies = texts.mapInArrow(
        _local, "sha string, length long, body binary, least long, ties long, copies long"
    )
    return (
        copies.repartition("length", "sha")
        .select("body", "least", "ties", "copies")
        .mapInArrow(_own, "owner_sha string, keep_id long, owner_ties long, group_size long")
    )


def owned(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    rows = docs.select("doc_id", F.sha2(normalised(), 256).alias("text_sha256"))
    joined = rows.join(owners(docs), F.col("text_sha256") == F.col("owner_sha"))
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, that with the smallest doc_id."""
    rows, back = set_aside(docs, ("doc_id", "text"))
    groups = owners(rows).where("group_size > 1").select("owner_sha", "keep_id", "owner_ties")
    marked = rows.withColumn("exact_sha", F.sha2(normalised(), 256)).join(
        groups, F.col("exact_sha") == F.col("owner_sha"), "left"
    )
    stays = F.col("owner_sha").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))
    stays = marked.where(stays)
    tied = stays.where("owner_ties > 1").dropDuplicates(["doc_id", "exact_sha"])
    single = stays.where("owner_ties is null or owner_ties = 1")
    return single.unionByName(tied).select(*back)
