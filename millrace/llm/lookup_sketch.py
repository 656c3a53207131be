"""Document fingerprints as invertible Bloom lookup sketches.

A text's paragraphs (lines, cut after sentences and into pieces of at most 120
characters) are a set of 64-bit digests. A sketch keeps, for three sub-tables of
cells, how many digests fall into a cell, their xor and the xor of their check
values. Sketches of two versions subtract cell by cell, what they share cancels,
and peeling the cells that hold one digest recovers every digest that differs,
which gives the likeness |A and B| / |A or B|. Pairs that do not peel are
sketched again with more cells and other hashes until they do.

Cells are rows: building, subtracting and each peeling round is one hash
aggregation within partitions by document, so no round shuffles and no group is
larger than one document. A round peels one sub-table, where a digest has only one
cell, so no digest is taken out twice.

The ``fingerprint`` is the sketch folded to twelve cells, written in hexadecimal.

DataFrame functions only. Nulls: a null text is an empty one, a null doc_id
counts as the smallest id. Rows that repeat an id and its text are one document
and get equal results. Two texts without paragraphs have likeness 1. A table with
one document has itself as next document; an empty one gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import text_or_empty, written

PIECE = r"[^.!?\n]{1,120}[.!?\n]*|[.!?\n]+"
_TABLES = 3
_CYCLES = 3
#: A written fingerprint has 2**2 cells per table.
_FOLDED_BITS = 2
_NO_ID = -(1 << 63)
#: The cells of so many documents fit a task's memory; with more they spill.
_TASK_DOCUMENTS = 2_000
_MOST_PARTS = 100_000
_KEY = ["key", "hash"]


def paragraphs(text: Column) -> Column:
    """Distinct digests of a text's pieces."""
    pieces = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda piece: F.xxhash64(piece)))


def _documents(docs: DataFrame, parts: int) -> DataFrame:
    """Each distinct (doc_id, text) once, in ``parts`` partitions by its key."""
    text = text_or_empty()
    return (
        docs.select(
            F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("key"),
            F.xxhash64(text).alias("hash"),
            text.alias("text"),
        )
        .repartition(parts, *_KEY)
        .groupBy(*_KEY)
        .agg(F.first("text").alias("text"))
    )


def following(docs: DataFrame) -> DataFrame:
    """Each distinct (doc_id, text) and the next one, by descending id.

    Has key, hash, n_chars, copies (rows), next_key and next_hash.

    Ids are range partitioned; within a partition the next one is a window away,
    and the last of a partition is followed by the first of the next, looked up
    in a table of one row per partition.
    """
    text = text_or_empty()
    ids = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("key"),
        F.xxhash64(text).alias("hash"),
        F.length(text).cast("long").alias("n_chars"),
    )
    ids = ids.groupBy(*_KEY, "n_chars").agg(F.count("*").alias("copies"))
    ranged = ids.repartitionByRange(F.col("key").desc(), F.col("hash").desc())
    placed = written(ranged.withColumn("part", F.spark_partition_id()), "order")
    order = W.partitionBy("part").orderBy(F.col("key").desc(), F.col("hash").desc())
    here = F.struct(*_KEY)
    numbered = placed.select("*", F.lead(here).over(order).alias("next"))
    heads = placed.groupBy("part").agg(F.max(here).alias("head"))
    parts = W.orderBy("part")
    first = F.first("head").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, 0))
    heads = heads.select(
        F.col("part").alias("p"), F.coalesce(F.lead("head").over(parts), first).alias("then")
    )
    # One row per partition of the range exchange.
    joined = numbered.join(F.broadcast(heads), F.col("part") == F.col("p"))
    after = F.coalesce("next", "then")
    return joined.select(
        *_KEY,
        "n_chars",
        "copies",
        after["key"].alias("next_key"),
        after["hash"].alias("next_hash"),
    )


def with_edit(docs: DataFrame, links: DataFrame) -> DataFrame:
    """Each linked document with its edited text and the digests of three versions."""
    rows = links.count()
    usual = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = _documents(docs, max(usual, min(_MOST_PARTS, -(-rows // _TASK_DOCUMENTS))))
    taken = links.select(
        F.col("key").alias("for_key"),
        F.col("hash").alias("for_hash"),
        F.floor(F.col("n_chars") / 2).cast("int").alias("half"),
        F.col("next_key").alias("key"),
        F.col("next_hash").alias("hash"),
    )
    heads = texts.join(taken, _KEY).select(
        "for_key",
        "for_hash",
        F.expr("substring(text, 1, half)").alias("head"),
        paragraphs(F.col("text")).alias("following"),
    )
    n = F.length("text")
    edited = F.concat(F.expr("substring(text, 1, length(text) - int(floor(length(text) / 2)))"), "head")
    return (
        texts.join(
            heads, (F.col("key") == F.col("for_key")) & (F.col("hash") == F.col("for_hash"))
        )
        .withColumn("edited", edited)
        .select(
            *_KEY,
            n.cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            paragraphs(F.col("text")).alias("own"),
            paragraphs(F.col("edited")).alias("edited"),
            "following",
        )
    )


# A cell's number: 6 bits for the size of its tables, 2 for its tag, 2 for its
# table, 40 for its place. A tag names what is sketched, see _subtracted. Digests that were
# found are counted in a cell of the tag's fourth table.
_BITS_AT, _TAG_AT, _TABLE_AT = 44, 42, 40
_FOUND = 3


def _number(bits: Column, tag, table: int, place: Column) -> Column:
    tag = F.lit(tag) if isinstance(tag, int) else tag
    high = bits.cast("long") * F.lit(1 << _BITS_AT) + tag.cast("long") * F.lit(1 << _TAG_AT)
    return high + F.lit(table << _TABLE_AT) + place


def _field(at: int, width: int) -> Column:
    return F.shiftright("cell", at).bitwiseAND(F.lit((1 << width) - 1))


def _place(digest: Column, table: int, seed: int, bits: Column) -> Column:
    mixed = F.xxhash64(digest, F.lit(table), F.lit(seed))
    return mixed.bitwiseAND(F.pow(F.lit(2.0), bits).cast("long") - 1)


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1))


def _cell(number: Column, count, xor: Column, check: Column) -> Column:
    count = F.lit(count) if isinstance(count, int) else count
    return F.struct(
        number.alias("cell"),
        count.cast("long").alias("count"),
        xor.alias("xor"),
        check.alias("check"),
    )


def _summed(cells: DataFrame, column: Column) -> DataFrame:
    """Add up cells of an array column; those in which everything cancels go."""
    return (
        cells.select(*_KEY, F.explode(column).alias("c"))
        .select(*_KEY, "c.*")
        .groupBy(*_KEY, "cell")
        .agg(
            F.sum("count").alias("count"),
            F.bit_xor("xor").alias("xor"),
            F.bit_xor("check").alias("check"),
        )
        .where("count <> 0 or xor <> 0 or check <> 0")
    )


def _subtracted(versions: DataFrame, seed: int, room: int) -> DataFrame:
    """Cells of own - edited (tag 0), own - following (1), own (2) and edited (3)."""
    most = F.size("own") + F.greatest(F.size("edited"), F.size("following"))
    bits = F.ceil(F.log2(F.lit(1.5 * room) * F.greatest(most, F.lit(1))))
    bits = F.least(F.greatest(bits, F.lit(5)), F.lit(39)).cast("int")

    def tagged(column: str, version: int) -> Column:
        return F.transform(column, lambda d: F.struct(F.lit(version).alias("v"), d.alias("d")))

    every = F.concat(tagged("own", 0), tagged("edited", 1), tagged("following", 2))
    digests = versions.select(*_KEY, bits.alias("bits"), F.explode(every).alias("unit"))
    d, v = F.col("unit.d"), F.col("unit.v")

    def cells_of(tag: int, sign: int) -> list[Column]:
        size, salt = (F.col("bits"), seed) if tag < 2 else (F.lit(_FOLDED_BITS), 0)
        return [
            _cell(_number(size, tag, t, _place(d, t, salt, size)), sign, d, _check(d))
            for t in range(_TABLES)
        ]

    own = F.array(*cells_of(0, 1), *cells_of(1, 1), *cells_of(2, 1))
    edited = F.array(*cells_of(0, -1), *cells_of(3, 1))
    return _summed(
        digests, F.when(v == 0, own).when(v == 1, edited).otherwise(F.array(*cells_of(1, -1)))
    )


def _peeled(cells: DataFrame, table: int, seed: int) -> DataFrame:
    """Take the digests that are alone in a cell of one table out of the others."""
    bits, tag = _field(_BITS_AT, 6), _field(_TAG_AT, 2)
    count, xor, check = F.col("count"), F.col("xor"), F.col("check")
    alone = (
        (tag < 2)
        & (_field(_TABLE_AT, 2) == table)
        & (F.abs(count) == 1)
        & (check == _check(xor))
    )
    nothing = F.lit(0).cast("long")
    out = [
        _cell(_number(bits, tag, t, _place(xor, t, seed, bits)), -count, xor, check)
        for t in range(_TABLES)
        if t != table
    ]
    found = _cell(_number(bits, tag, _FOUND, nothing), 1, nothing, nothing)
    stays = F.array(_cell(F.col("cell"), count, xor, check))
    return _summed(cells, F.when(alone, F.array(*out, found)).otherwise(stays))


def _written_sketch(tag: int) -> Column:
    cell = F.when(_field(_TAG_AT, 2) == tag, F.struct("cell", "count", "xor", "check"))
    text = F.transform(
        F.array_sort(F.collect_list(cell)),
        lambda c: F.concat_ws(
            ".",
            F.shiftright(c["cell"], _TABLE_AT).bitwiseAND(F.lit(3)) * (1 << _FOLDED_BITS)
            + c["cell"].bitwiseAND(F.lit((1 << _FOLDED_BITS) - 1)),
            c["count"],
            F.hex(c["xor"]),
            F.hex(F.shiftrightunsigned(c["check"], 32)),
        ),
    )
    return F.lower(F.array_join(text, "-"))


def _attempt(docs: DataFrame, links: DataFrame, seed: int) -> DataFrame:
    versions = with_edit(docs, links)
    cells = _subtracted(versions, seed, 4**seed)
    for _ in range(_CYCLES):
        for at in range(_TABLES):
            cells = _peeled(cells, at, seed)
    is_found = _field(_TABLE_AT, 2) == _FOUND
    is_left = (_field(_TAG_AT, 2) < 2) & ~is_found

    def found(tag: int) -> Column:
        return F.sum(F.when(is_found & (_field(_TAG_AT, 2) == tag), F.col("count")))

    per_doc = cells.groupBy(F.col("key").alias("k"), F.col("hash").alias("g")).agg(
        F.max(is_left).alias("stuck"),
        found(0).alias("edited_differs"),
        found(1).alias("next_differs"),
        _written_sketch(2).alias("fingerprint"),
        _written_sketch(3).alias("edited_fingerprint"),
    )
    joined = versions.select(
        *_KEY,
        "n_chars",
        "edited_sha256",
        F.size("own").alias("n_own"),
        F.size("edited").alias("n_edited"),
        F.size("following").alias("n_next"),
    ).join(per_doc, (F.col("key") == F.col("k")) & (F.col("hash") == F.col("g")), "left")

    def likeness(size: str, differs: str) -> Column:
        both = F.col("n_own") + F.col(size)
        d = F.coalesce(differs, F.lit(0))
        return F.when(both == 0, 1.0).otherwise((both - d) / (both + d))

    return joined.select(
        *_KEY,
        "n_chars",
        "edited_sha256",
        F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
        F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
        likeness("n_edited", "edited_differs").alias("near_edited"),
        likeness("n_next", "next_differs").alias("near_next"),
        F.coalesce("stuck", F.lit(False)).alias("stuck"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited and near_next."""
    docs = docs.select("doc_id", "text")
    links = written(following(docs), "links")
    copies = links.select(*_KEY, "copies")
    done, seed = None, 0
    while True:
        tried = written(_attempt(docs, links, seed), "sketches")
        peeled = tried.where("not stuck")
        done = peeled if done is None else done.unionByName(peeled)
        stuck = tried.where("stuck").select(*_KEY)
        if stuck.isEmpty():
            break
        # Written, so that Spark knows how few they are and need not shuffle the texts.
        links = written(links.join(stuck, _KEY, "left_semi"), "links")
        needed = links.select("key").union(links.select(F.col("next_key"))).distinct()
        needed = written(needed, "needed")
        docs = docs.join(
            needed, F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)) == F.col("key"), "left_semi"
        )
        seed += 1
    rows = done.join(copies, _KEY).withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(
        F.when(F.col("key") != _NO_ID, F.col("key")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )
