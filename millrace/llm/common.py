"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path

#: A word is a run of anything but space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh shared path whose files go when the session's JVM ends."""
    path = scratch_path(spark, name)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(place)
    system.deleteOnExit(place)
    return path


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it Spark drops a query's shuffle files as soon as the query has ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def added(df: DataFrame, path: str) -> None:
    """Write the rows to a folder, beside those it holds; the shuffle files behind them go."""
    with _shuffles_freed(df.sparkSession):
        df.write.mode("append").option("compression", "zstd").parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, once computed and read back from the shared folder.

    Cuts the lineage: what follows survives the loss of any executor without
    repeating what came before, and reads only the columns it needs. The shuffle
    files behind the rows are then of no use and go.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    added(df, path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def written_for_now(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like :func:`written`, but the files go at the end of the block."""
    spark = df.sparkSession
    path = scratch(spark, name)
    added(df, path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def set_aside(docs: DataFrame, used: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """The rows with every column but ``used`` under a name of its own, and the way back.

    Operators may then add columns of any name; selecting the second part gives the
    caller's columns again, in their order.
    """
    mine = {name: f"given_{n}" for n, name in enumerate(docs.columns) if name not in used}
    aside = docs.select(*(F.col(f"`{n}`").alias(mine.get(n, n)) for n in docs.columns))
    return aside, [F.col(mine[n]).alias(n) if n in mine else F.col(n) for n in docs.columns]


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """The rows with ``number``, their place from 0 in the order of some columns.

    A range sort, with one count per shuffle partition; no task sees all rows.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id holds the partition above its lowest 33 bits, and the place in it.
    placed = written(ordered.withColumn("place", F.monotonically_increasing_id()), name)
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).count().orderBy("part").collect()
    firsts = accumulate((row["count"] for row in sizes), initial=0)
    begins = rows.sparkSession.createDataFrame(
        [(row.part, n) for row, n in zip(sizes, firsts)], "part long, before long"
    )
    number = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(begins), part == F.col("part")).select(*rows.columns, number.alias("number"))


def byte_characters() -> dict[str, int]:
    """The bytes that byte-level vocabularies mean by their characters: visible ones are
    written as they are, the others as characters from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}
