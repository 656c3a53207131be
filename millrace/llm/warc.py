"""Archive conversion: ARC records of either version to WARC, and back to rows.

An ARC stream begins with a version block whose body names the version and the
fields of each record's header line; a record is its header line and as many
bytes as the line declares. The converter reads both versions by the fields they
declare and synthesises what WARC asks for: record ids, timestamps, types and
digests. Payloads of at least ``least_bytes`` bytes that repeat become revisits
of the one with the largest page id.

Archives are written by Spark's text writer with CRLF as separator, which gives
plain concatenated records, compressed as a whole; any file system Spark can
write to will do. Files are read back as a stream, one record in memory at a
time.

Nulls: a null html is an empty payload, a null url is ``-``; a null page_id comes
back as null and loses to any id. Rows that repeat an id and its payload are all
responses if any is. Empty tables give no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import scratch

# Field names of the two ARC versions' header lines.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
    "Filename Archive-length",
}
# Fixed value: the profile of revisit records with equal payloads.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def arc_streams(pages: DataFrame) -> DataFrame:
    """One ARC stream per page: a version block and the page's record.

    Even and odd pages use version 1 and 2, so both kinds of header occur.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    page = F.coalesce(F.concat(F.lit("X-Page-Id: "), F.col("page_id"), F.lit("\r\n")), F.lit(""))
    body = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(html),
        F.lit("\r\n"),
        page,
        F.lit("\r\n"),
        html,
    )
    url = F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("-")), r"[\s\x00]", "%20")
    url = F.when(F.length(url) == 0, F.lit("-")).otherwise(url)
    stamp = F.date_format(
        F.timestamp_seconds(F.lit(946_684_800) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**8))),
        "yyyyMMddHHmmss",
    )
    start = F.concat(url, F.lit(" 0.0.0.0 "), stamp, F.lit(" text/html "))

    def stream(version: int, middle: str) -> Column:
        block = f"{version} 0 corpus\n{ARC_FIELDS[version]}\n"
        rest = f"{middle}{len(block)}"
        return F.concat(
            F.lit(f"filedesc://pages.arc 0.0.0.0 20000101000000 text/plain {rest}\n{block}\n"),
            start,
            F.lit(middle),
            F.octet_length(body),
            F.lit("\n"),
            body,
            F.lit("\n"),
        )

    first = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(2)) == 0
    both = F.when(first, stream(1, "")).otherwise(stream(2, "200 - - 0 pages.arc "))
    return pages.select(both.cast("binary").alias("content"))


def arc_records(data: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content of each record of an ARC stream of either version.

    A new version block may follow at any point, as in concatenated files.
    """
    fields: list[str] = []
    while line := data.readline():
        line = line.strip()
        if not line:
            continue
        parts = line.decode("utf-8", "surrogateescape").split(" ")
        size = int(parts[-1])
        content = data.read(size)
        if len(content) < size:
            raise ValueError(f"ARC record ends after {len(content)} of {size} bytes")
        if parts[0].startswith("filedesc://"):
            about, names = content.decode().split("\n")[:2]
            fields = names.split()
            if about.split(" ", 1)[0] not in ("1", "2"):
                raise ValueError(f"unknown ARC version in {about!r}")
            continue
        if len(parts) != len(fields):
            raise ValueError(f"ARC header has {len(parts)} of {len(fields)} fields")
        yield dict(zip(fields, parts)), content


def _head_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


_CONVERTED = {
    "page_id": pa.int64(),
    "record_id": pa.string(),
    "uri": pa.string(),
    "ip": pa.string(),
    "date": pa.string(),
    "head": pa.binary(),
    "payload": pa.binary(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
}
_CONVERTED_SQL = (
    "page_id long, record_id string, uri string, ip string, date string, head binary, "
    "payload binary, payload_bytes long, payload_digest string"
)


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 8 << 20):
    held, taken = [], 0
    for row in rows:
        held.append(row)
        taken += 200 + sum(len(x) for x in row if isinstance(x, bytes))
        if taken > size:
            yield _batch(held, schema)
            held, taken = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def convert(streams: DataFrame) -> DataFrame:
    """ARC streams (binary ``content``, one or many records) to what WARC records need."""
    schema = pa.schema(list(_CONVERTED.items()))

    def rows(batches) -> Iterator[tuple]:
        for batch in batches:
            for content in batch.column(0):
                for about, block in arc_records(io.BytesIO(content.as_py())):
                    yield converted(about, block)

    def converted(about: dict[str, str], block: bytes) -> tuple:
        head, blank, payload = block.partition(b"\r\n\r\n")
        if not blank:
            head, payload = b"", block
        http = _head_fields(head)
        d = about["Archive-date"]
        date = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
        digest = hashlib.sha1(payload).hexdigest()
        page = http.get("x-page-id")
        name = f"{about['URL']} {date} {page} {digest}"
        return (
            _number(page),
            f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
            about["URL"],
            about["IP-address"],
            date,
            head + b"\r\n\r\n",
            payload,
            len(payload),
            digest,
        )

    return streams.select("content").mapInArrow(
        lambda batches: _in_batches(rows(batches), schema), _CONVERTED_SQL
    )


def with_revisits(records: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Adds record_type and refers_to; only keys and ids of payloads are grouped."""
    keys = records.select(
        "payload_digest", "payload_bytes", F.xxhash64("payload").alias("content_hash"), "page_id",
        "record_id",
    ).where(F.col("payload_bytes") >= least_bytes)
    newest = F.struct(F.col("page_id").alias("first_page"), F.col("record_id").alias("first_id"))
    groups = (
        keys.groupBy(
            F.col("payload_digest").alias("d"),
            F.col("payload_bytes").alias("b"),
            F.col("content_hash").alias("h"),
        )
        .agg(F.max(newest).alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("d", "b", "h", "first.*")
    )
    joined = records.withColumn("content_hash", F.xxhash64("payload")).join(
        groups,
        (F.col("payload_digest") == F.col("d"))
        & (F.col("payload_bytes") == F.col("b"))
        & (F.col("content_hash") == F.col("h")),
        "left",
    )
    again = F.col("d").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    return joined.select(
        *records.columns,
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_page")).alias("refers_to"),
        F.when(again, F.col("first_id")).alias("refers_to_id"),
    )


def warc_text(records: DataFrame) -> DataFrame:
    """Each record's bytes without its last line end, in a column ``value``."""
    again = F.col("record_type") == "revisit"

    def field(name: str, value) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    block = F.when(again, F.col("head")).otherwise(F.concat("head", "payload"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", F.col("record_id")),
        field("WARC-Target-URI", F.col("uri")),
        field("WARC-Date", F.col("date")),
        field("WARC-IP-Address", F.col("ip")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        field("WARC-Profile", F.when(again, F.lit(REVISIT_PROFILE))),
        field("WARC-Refers-To", F.col("refers_to_id")),
        field("Page-Refers-To", F.col("refers_to").cast("string")),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    whole = F.concat(head.cast("binary"), block, F.lit("\r\n").cast("binary"))
    return records.select(whole.cast("string").alias("value"))


def write_warcs(records: DataFrame, path: str, records_per_file: int = 2000) -> None:
    (
        warc_text(records)
        .write.mode("overwrite")
        .option("lineSep", "\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def warc_records(data: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each WARC record of a stream."""
    while line := data.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        head = [line]
        while (line := data.readline()) not in (b"\r\n", b""):
            head.append(line)
        fields = _head_fields(b"".join(head))
        size = int(fields["content-length"])
        block = data.read(size)
        if len(block) < size:
            raise ValueError(f"WARC record ends after {len(block)} of {size} bytes")
        yield fields, block


_READ = {
    "page_id": pa.int64(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "record_type": pa.string(),
    "refers_to": pa.int64(),
    "record_id": pa.string(),
    "uri": pa.string(),
    "date": pa.string(),
    "payload": pa.binary(),
}


def read_warcs(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of all archives below ``path``; digests of responses are verified.

    A revisit's size and digest are those of the payload it stands for.
    """
    names = [n for n in _READ if payloads or n != "payload"]
    schema = pa.schema([(n, _READ[n]) for n in names])

    def rows(batches) -> Iterator[tuple]:
        for batch in batches:
            for content in batch.column(0):
                with gzip.open(io.BytesIO(content.as_py())) as data:
                    for fields, block in warc_records(data):
                        yield read(fields, block)[: len(names)]

    def read(fields: dict[str, str], block: bytes) -> tuple:
        head, _, payload = block.partition(b"\r\n\r\n")
        http = _head_fields(head)
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].partition(":")[2]
        size = len(payload) if kind == "response" else int(http["content-length"])
        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} is not what was written")
        page, refers = _number(http.get("x-page-id")), _number(fields.get("page-refers-to"))
        about = fields["warc-record-id"], fields["warc-target-uri"], fields["warc-date"]
        return page, size, digest, kind, refers, *about, payload

    # SQL names of the Arrow types above.
    sql = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(
        lambda batches: _in_batches(rows(batches), schema),
        ", ".join(f"{n} {sql[_READ[n]]}" for n in names),
    )


def archived(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """The pages as ARC, converted to WARC archives and read back."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_warcs(with_revisits(convert(arc_streams(pages)), least_bytes), path)
    return read_warcs(spark, path)
