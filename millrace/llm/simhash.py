"""SimHash fingerprints and near duplicates by a self-join of binary tries.

A fingerprint bit is set if it is set in more than half of the hashes of the
text's word shingles. Fingerprints that differ in few bits are found by walking
two tries together: a pair of nodes carries the bits in which its prefixes
differ, and is dropped as soon as they exceed the budget. Fingerprints within
``errors`` bits differ in at most half of that in one half of their bits, so two
tries, one per half, each walk their half with half the budget.

The tries are cut at a prefix: each pair of prefix nodes within the budget is one
group of tasks' work. A node with many fingerprints is cut into chunks by hash,
and chunk pairs are groups of their own. Groups return a spanning forest of the
links they find, never all pairs.

Nulls: a null text has no words and fingerprint 0; a null doc_id takes part and
counts as larger than any id. Repeated rows share their component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import set_aside, text_or_empty, written
from millrace.llm.components import components

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_HASHES = 1 << 15
_NODE_ROWS = 8_192
_PAIRS = 1 << 20


def shingle_places(text: str, width: int) -> tuple[bytes, list[int], list[int]]:
    """A text's words joined by spaces, and where each shingle starts and ends."""
    words = text.encode().translate(_LOWER).split()
    joined = b" ".join(words)
    if len(words) <= width:
        return joined, [0], [len(joined)]
    after = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    return joined, np.concatenate([[0], after[:-width]]).tolist(), (after[width - 1 :] - 1).tolist()


def fingerprint(text: str, width: int) -> int:
    """The 64-bit fingerprint, as a signed integer."""
    joined, starts, ends = shingle_places(text, width)
    if not joined:
        return 0
    hashed, counts = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(starts), _HASHES):
        part = zip(starts[at : at + _HASHES], ends[at : at + _HASHES])
        digests = b"".join([hashed(joined[a:b], 42) for a, b in part])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    majority = np.packbits(counts * 2 > len(starts))
    return int(majority.view(">i8")[0])


def with_fingerprint(docs: DataFrame, name: str = "simhash", width: int = 4) -> DataFrame:
    @F.pandas_udf("long")
    def compute(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t or "", width) for t in texts], dtype="int64")

    return docs.withColumn(name, compute(F.col("text").cast("string")))


def _middle(keys: np.ndarray, low: np.ndarray, depth: int) -> np.ndarray:
    """Where the node that starts at ``low`` changes from bit 0 to bit 1."""
    bit = np.uint64(1) << np.uint64(63 - depth)
    above = ~((bit << np.uint64(1)) - np.uint64(1)) if depth else np.uint64(0)
    return np.searchsorted(keys, (keys[low] & above) | bit)


def near_pairs(
    a: np.ndarray, b: np.ndarray, depth: int, errors: int, half: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted keys within ``errors`` bits, ``half`` in the first 32.

    All keys of a side share their first ``depth`` bits.
    """
    seen = int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(64 - depth))) if depth else 0
    one = np.zeros(1, np.int64)
    stack = [(depth, one, one + len(a), one, one + len(b), one + seen)]
    while stack:
        depth, a0, a1, b0, b1, wrong = stack.pop()
        keep = (a1 > a0) & (b1 > b0) & (wrong <= (half if depth <= 32 else errors))
        a0, a1, b0, b1, wrong = (x[keep] for x in (a0, a1, b0, b1, wrong))
        product = (a1 - a0) * (b1 - b0)
        small = (product <= 8) | (depth == 64)
        yield from _leaves(a, b, *(x[small] for x in (a0, a1, b0, b1)), errors, half)
        a0, a1, b0, b1, wrong = (x[~small] for x in (a0, a1, b0, b1, wrong))
        if not len(a0):
            continue
        for at in range(0, len(a0), _PAIRS):
            p0, p1, q0, q1, w = (x[at : at + _PAIRS] for x in (a0, a1, b0, b1, wrong))
            pm, qm = _middle(a, p0, depth), _middle(b, q0, depth)
            stack.append(
                (
                    depth + 1,
                    np.concatenate([p0, pm, p0, pm]),
                    np.concatenate([pm, p1, pm, p1]),
                    np.concatenate([q0, qm, qm, q0]),
                    np.concatenate([qm, q1, q1, qm]),
                    np.concatenate([w, w, w + 1, w + 1]),
                )
            )


def _leaves(a, b, a0, a1, b0, b1, errors: int, half: int):
    """Compare the few fingerprints of each pair of small nodes."""
    counts = (a1 - a0) * (b1 - b0)
    limits = np.searchsorted(np.cumsum(counts), np.arange(0, counts.sum() + _PAIRS, _PAIRS))
    for start, stop in zip(limits, [*limits[1:], len(counts)]):
        n = counts[start:stop]
        if not n.sum():
            continue
        first = np.repeat(np.cumsum(n) - n, n)
        place = np.arange(n.sum()) - first
        wide = np.repeat(b1[start:stop] - b0[start:stop], n)
        i = np.repeat(a0[start:stop], n) + place // wide
        j = np.repeat(b0[start:stop], n) + place % wide
        differ = a[i] ^ b[j]
        near = np.bitwise_count(differ) <= errors
        near &= np.bitwise_count(differ >> np.uint64(32)) <= half
        if near.any():
            yield i[near], j[near]


class Forest:
    """Labels of 0..n-1 joined by pairs, smallest number first."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            x, y = self.label[i], self.label[j]
            apart = x != y
            if not apart.any():
                return
            i, j = i[apart], j[apart]
            high, low = np.maximum(x, y)[apart], np.minimum(x, y)[apart]
            np.minimum.at(self.label, high, low)
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def links(prints: DataFrame, errors: int = 4) -> DataFrame:
    """A spanning forest (src, dst) of distinct fingerprints within ``errors`` bits."""
    total = prints.count()
    depth = min(16, max(3, (total // _NODE_ROWS).bit_length()))
    half = errors // 2
    masks = [
        sum(1 << bit for bit in bits)
        for n in range(half + 1)
        for bits in combinations(range(depth), n)
    ]
    key = F.col("simhash")
    turned = F.shiftleft(key, 32).bitwiseOR(F.shiftrightunsigned(key, 32))
    keys = prints.select(
        "simhash", F.posexplode(F.array(key, turned)).alias("trie", "key")
    ).withColumn("node", F.shiftrightunsigned("key", 64 - depth).cast("int"))
    # At most 2 * 2**16 rows, whatever the input.
    nodes = keys.groupBy("trie", "node").agg(
        F.ceil(F.count("*") / F.lit(2 * _NODE_ROWS)).cast("int").alias("chunks")
    )
    mine = nodes.select("trie", "node", F.col("chunks").alias("own"))
    theirs = nodes.select("trie", F.col("node").alias("other"), "chunks")
    spread = (
        keys.join(F.broadcast(mine), ["trie", "node"])
        .withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("own")).cast("int"))
        .withColumn("mask", F.explode(F.array(*map(F.lit, masks))))
        .withColumn("other", F.col("node").bitwiseXOR(F.col("mask")))
        .join(F.broadcast(theirs), ["trie", "other"])
        .withColumn("against", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    )
    me = F.struct(F.col("node").alias("n"), F.col("chunk").alias("c"))
    it = F.struct(F.col("other").alias("n"), F.col("against").alias("c"))
    groups = spread.select(
        "trie",
        "key",
        F.least(me, it).alias("low"),
        F.greatest(me, it).alias("high"),
        F.when(me == it, 2).when(me < it, 0).otherwise(1).alias("side"),
    )

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        keys, side = rows["key"].to_numpy().view(np.uint64), rows["side"].to_numpy()
        a, b = np.sort(keys[side != 1]), np.sort(keys[side != 0])
        if not len(a) or not len(b):
            return pd.DataFrame({"src": [], "dst": []}, dtype="int64")
        both = np.concatenate([a, b])
        same = side[0] == 2
        forest = Forest(len(both))
        for i, j in near_pairs(a, b, depth, errors, half):
            if same:
                i, j = i[i < j], j[i < j]
            else:
                j = j + len(a)
            forest.join(i, j)
        linked = np.flatnonzero(forest.label != np.arange(len(both)))
        out = [both[linked], both[forest.label[linked]]]
        if rows["trie"].iloc[0] == 1:
            out = [(x << np.uint64(32)) | (x >> np.uint64(32)) for x in out]
        return pd.DataFrame({"src": out[0].view(np.int64), "dst": out[1].view(np.int64)})

    return groups.groupBy("trie", "low", "high").applyInPandas(walk, "src long, dst long")


def grouped(docs: DataFrame, errors: int = 4, width: int = 4) -> DataFrame:
    """doc_id, simhash and component_id of every row, with two hashes of its text."""
    text = text_or_empty()
    keys = [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]
    rows = written(
        with_fingerprint(docs.select("doc_id", "text", *keys), width=width).drop("text"), "simhash"
    )
    prints = rows.groupBy("simhash").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(prints, errors))
    tied = prints.join(roots, F.col("simhash") == F.col("node"), "left").select(
        F.col("simhash").alias("print"),
        "first_id",
        F.coalesce("root", "simhash").alias("root"),
    )
    smallest = tied.groupBy(F.col("root").alias("top")).agg(F.min("first_id").alias("component_id"))
    named = tied.join(smallest, F.col("root") == F.col("top")).select("print", "component_id", "root")
    return rows.join(named, F.col("simhash") == F.col("print")).drop("print")


def near_duplicates(docs: DataFrame, errors: int = 4, width: int = 4) -> DataFrame:
    """doc_id, simhash (signed) and component_id of every row.

    component_id is the smallest doc_id reachable over links of fingerprints
    that differ in at most ``errors`` bits.
    """
    return grouped(docs, errors, width).select("doc_id", "simhash", "component_id")


def deduplicated(docs: DataFrame, errors: int = 4, width: int = 4) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest doc_id.

    Rows are told apart by id and text together: of rows that share the smallest id the one
    with the smallest hashes of its text stays, and of rows alike in both one. A null id
    counts as larger than any other.
    """
    rows, back = set_aside(docs, ("doc_id", "text"))
    # Copies of a row count once; a group's first row is its smallest by id, then text.
    found = grouped(rows, errors, width).groupBy("doc_id", "t1", "t2", "root").agg(F.count("*").alias("copies"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "t1", "t2")
    firsts = found.groupBy(F.col("root").alias("top")).agg(F.min(place).alias("first"))
    marked = found.join(firsts, F.col("root") == F.col("top")).select(
        F.col("doc_id").alias("id"), "t1", "t2", (place == F.col("first")).alias("first"), "copies"
    )
    # What stays as it is, nearly all rows, need not be named.
    named = marked.where(~F.col("first") | (F.col("copies") > 1))
    text = text_or_empty()
    same = (
        F.col("doc_id").eqNullSafe(F.col("id"))
        & (F.xxhash64(text) == F.col("t1"))
        & (F.xxhash64(F.lit(1), text) == F.col("t2"))
    )
    joined = rows.join(named, same, "left")
    single = joined.where("first is null")
    repeated = joined.where("first").dropDuplicates(["id", "t1", "t2"])
    return single.unionByName(repeated).select(*back)
