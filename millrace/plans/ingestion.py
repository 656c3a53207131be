"""Ingest customer files into the versioned training table."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.validation import accepted, check_records, quarantined
from millrace.settings import Settings
from millrace.sources import files as csv_files
from millrace.sources.tables import BucketedTable, write_batch

# The order of rows in the table: by batch, then by place in its files.
INGEST_ORDER = ["batch_id", *csv_files.POSITION]

#: How the conditions of errors begin that are a file's own.
UNREADABLE = ("FAILED_READ_FILE", "PATH_NOT_FOUND", "MALFORMED_CSV_RECORD")


def required_columns(settings: Settings) -> list[str]:
    return [*schemas.RAW_FEATURES, settings.target_column, settings.id_column]


class Ingestion:
    """Appends batches of files to a table, keeping the last row per customer.

    All files of a batch are checked before anything is written. A file lacking
    a required column is left out and logged; the others go in together. Files
    are known to the log by path, modification time and length: the same file
    counts once however often it is delivered, while a corrected file and other
    contents under a used name are taken. A file that cannot be read is logged as such and
    holds up no other. Batch 0 is the seed; later batches are deltas of the table.

    ``quarantine`` names a folder for rows outside the record domain; without
    it every row of an accepted file enters the table.
    """

    def __init__(
        self,
        spark: SparkSession,
        table_path: str,
        settings: Settings = Settings(),
        quarantine: str | None = None,
        buckets: int = 16,
    ):
        self.spark = spark
        self.settings = settings
        self.table = BucketedTable(spark, table_path, settings.id_column, INGEST_ORDER, buckets)
        self.quarantine = quarantine

    def seed(self, paths: list[str]) -> None:
        """Start the table from its first files; a bad header is an error here."""
        found = csv_files.open_headers(self.spark, paths)
        _, rejected = csv_files.split_by_header(found, required_columns(self.settings))
        if rejected:
            gaps = {file.path: missing for file, missing in rejected.items()}
            raise ValueError(f"missing required columns: {gaps}")
        self._ingest(found, {}, 0, merge=False)

    def unknown(self, files: DataFrame) -> DataFrame:
        """Those of the listed files that the log does not know."""
        logged = self.table.commits().select(*csv_files.IDENTITY).distinct()
        return files.join(logged, list(csv_files.IDENTITY), "left_anti")

    def run_batch(self, paths: list[str]) -> None:
        """Ingest those of the files that the log does not know yet, as one batch."""
        if not paths:
            return
        fresh = self.unknown(csv_files.listed(self.spark, paths, "*"))
        # Names of the caller's own list.
        paths = [row.source_file for row in fresh.select("source_file").collect()]
        if paths:
            self._take(paths, max(self.table.state().batch_id, 0) + 1)

    def _take(self, paths: list[str], batch_id: int) -> int:
        """Ingest files, each half on its own if one cannot be read; the next batch id."""
        try:
            found = csv_files.open_headers(self.spark, paths)
            good, rejected = csv_files.split_by_header(found, required_columns(self.settings))
            self._ingest(good, rejected, batch_id, merge=True)
            return batch_id + 1
        except PySparkException as error:
            if not (error.getCondition() or "").startswith(UNREADABLE):
                raise
        if len(paths) > 1:
            half = len(paths) // 2
            return self._take(paths[half:], self._take(paths[:half], batch_id))
        rows = csv_files.listed(self.spark, paths, "*").select(*csv_files.IDENTITY)
        self.table.commit(rows.withColumn("status", F.lit("unreadable")), batch_id=batch_id)
        return batch_id + 1

    def _ingest(
        self,
        found: list[csv_files.CsvFile],
        rejected: dict[csv_files.CsvFile, list[str]],
        batch_id: int,
        merge: bool,
    ) -> None:
        log = self._log(
            [(f.path, f.modified, f.length, None, "rejected", gap) for f, gap in rejected.items()]
        )
        written = None
        if found:
            rows = csv_files.read_csv_by_name(self.spark, found, schemas.CUSTOMER)
            rows = rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
            # Parse the text once; the steps below read columns.
            rows = self.table.stage(rows)
            kept = self._checked(rows, batch_id)
            written = self.table.upsert(kept) if merge else self.table.replace(kept, keys_unique=False)
            log = log.unionByName(self._accepted_log(rows, found))
        self.table.commit(log, written, batch_id)

    def _checked(self, rows: DataFrame, batch_id: int) -> DataFrame:
        if not self.quarantine:
            return rows
        checked = check_records(rows)
        write_batch(quarantined(checked), self.quarantine, batch_id)
        return accepted(checked)

    def _log(self, rows: list[tuple]) -> DataFrame:
        return self.spark.createDataFrame(
            rows,
            "source_file string, modified timestamp, length long, n_rows long, status string, "
            "missing_columns array<string>",
        )

    def _accepted_log(self, rows: DataFrame, found: list[csv_files.CsvFile]) -> DataFrame:
        """Rows per accepted file; a file with nothing but a header counts 0."""
        counts = rows.groupBy("source_file").agg(F.count("*").alias("n"))
        names = self.spark.createDataFrame(
            [(file.path, file.modified, file.length, file.uri) for file in found],
            "source_file string, modified timestamp, length long, uri string",
        )
        counts = counts.withColumnRenamed("source_file", "uri")
        return names.join(counts, "uri", "left").select(
            *csv_files.IDENTITY,
            F.coalesce("n", F.lit(0)).alias("n_rows"),
            F.lit("ingested").alias("status"),
            F.lit(None).cast("array<string>").alias("missing_columns"),
        )
