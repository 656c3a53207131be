"""CSV readers that respect each file's own header, and row positions."""

from __future__ import annotations

import csv
import re
from collections import Counter, defaultdict
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas

# Where a row stood in its file: enough to order all rows of a set of files.
POSITION = ("source_file", "block_start", "row_no")


def read_telemetry_csv(spark: SparkSession, path: str) -> DataFrame:
    """Telemetry with its declared types, columns found by name: no inference pass.

    The names come from the header; columns may stand in any order and further
    ones are left out. ``enforceSchema=False`` compares each file's header with
    that order, so a file that differs fails the read instead of being taken by
    position. A missing column is an error.
    """
    reader = spark.read.option("header", True)
    names = reader.csv(path).columns
    missing = sorted(set(schemas.TELEMETRY.names) - set(names))
    if missing:
        raise ValueError(f"header {names} lacks {missing}")
    types = {field.name: field.dataType for field in schemas.TELEMETRY.fields}
    layout = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    scan = spark.read.schema(layout).option("header", True).option("enforceSchema", False)
    return scan.csv(path).select(*schemas.TELEMETRY.names)


class CsvFile(NamedTuple):
    """A file: its path, its name in Spark's scans, what tells its contents, its header.

    A path may be used again for other contents, so a file is known by path,
    modification time and length together.
    """

    path: str
    uri: str
    modified: datetime
    length: int
    columns: tuple[str, ...]


#: What tells one file from another in a log.
IDENTITY = ("source_file", "modified", "length")


def literal(path: str) -> str:
    """A path as readers take it that expand patterns: brackets and the like stand for themselves."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def listed(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """Files by :data:`IDENTITY` and their ``uri``; no file is opened. Paths are literal."""
    paths = [literal(path) for path in ([paths] if isinstance(paths, str) else paths)]
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(paths)
    return listing.select(
        F.col("path").alias("source_file"),
        F.col("modificationTime").alias("modified"),
        "length",
        F.col("_metadata.file_path").alias("uri"),
    )


def list_csv(spark: SparkSession, path: str) -> list[str]:
    """CSV files directly in a folder (or the one file), in path order."""
    names = listed(spark, path).select("source_file").orderBy("source_file")
    return [row.source_file for row in names.collect()]


def _names(line: str | None) -> tuple[str, ...]:
    """The columns of a header line; empty and repeated names get their place."""
    found = next(csv.reader([(line or "").removeprefix("\ufeff")]), [])
    used = Counter(name.lower() for name in found)
    return tuple(
        f"_c{i}" if not name else f"{name}{i}" if used[name.lower()] > 1 else name
        for i, name in enumerate(found)
    )


def open_headers(spark: SparkSession, paths: list[str]) -> list[CsvFile]:
    """The files by path with their headers, in one distributed read of all of them.

    The header is the first line that is not blank; every task keeps one line
    per file. A file without lines has no columns.
    """
    if not paths:
        return []
    lines = spark.read.text([literal(path) for path in paths]).select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    first = (
        lines.where("start = 0 and trim(value) != ''")
        .groupBy("uri")
        .agg(F.min_by("value", "place").alias("header"))
    )
    found = listed(spark, paths, "*").join(first, "uri", "left").orderBy("source_file")
    return [
        CsvFile(row.source_file, row.uri, row.modified, row["length"], _names(row.header))
        for row in found.collect()
    ]


def split_by_header(
    found: list[CsvFile], required: list[str]
) -> tuple[list[CsvFile], dict[CsvFile, list[str]]]:
    """Accepted files, and rejected ones with their sorted missing columns."""
    gaps = {file: sorted(set(required) - set(file.columns)) for file in found}
    accepted = [file for file, missing in gaps.items() if not missing]
    return accepted, {file: missing for file, missing in gaps.items() if missing}


def with_position(scan: DataFrame) -> DataFrame:
    """Add :data:`POSITION`; must sit directly on a file scan.

    A block is read by one task in file order, so the increasing id orders the
    rows of a block, and (file, block, id) orders all rows.
    """
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_no"),
    )


def readable(name: str, kind: T.DataType) -> Column:
    """A text cell as ``kind``, null where it cannot be read.

    Whole numbers may be written with a point ("1.0"), as exports do once a
    column has a gap; a fraction is not cut off but unreadable.
    """
    text = F.trim(F.col(name))
    if isinstance(kind, T.StringType):
        return F.col(name)
    if isinstance(kind, T.IntegralType):
        number = text.try_cast("decimal(38, 10)")
        return F.when(number == F.floor(number), number.try_cast(kind))
    return text.try_cast(kind)


def read_csv_by_name(
    spark: SparkSession,
    found: list[CsvFile],
    types: T.StructType,
) -> DataFrame:
    """Read files whose headers are known, matching columns by name.

    Files sharing a header are one scan. Columns of ``types`` get their type
    (null where a file lacks them or a cell does not read as one, which the record
    check reports); extra columns are kept as text.
    """
    if not found:
        empty = T.StructType(
            [
                *types.fields,
                T.StructField("source_file", T.StringType()),
                T.StructField("block_start", T.LongType()),
                T.StructField("row_no", T.LongType()),
            ]
        )
        return spark.createDataFrame([], empty)
    layouts: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file in found:
        layouts[file.columns].append(literal(file.path))
    known = {field.name: field.dataType for field in types.fields}
    scans = []
    for names, paths in layouts.items():
        layout = T.StructType([T.StructField(name, T.StringType()) for name in names])
        scan = spark.read.schema(layout).option("header", True).csv(paths)
        typed = {
            n: readable(n, t) if n in names else F.lit(None).cast(t) for n, t in known.items()
        }
        scans.append(with_position(scan).withColumns(typed))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    extras = [c for c in union.columns if c not in known and c not in POSITION]
    return union.select(*known, *extras, *POSITION)


def read_raw_customers(spark: SparkSession, path: str) -> DataFrame:
    """Raw customer files; totals stay text because they can be blank."""
    found = open_headers(spark, list_csv(spark, path))
    return read_csv_by_name(spark, found, schemas.RAW_CUSTOMER)
