"""Ingest files as they arrive in a folder: as a stream, or by a listing now and then."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.plans.ingestion import Ingestion
from millrace.sources.files import listed
from millrace.sources.folder_stream import FORMAT, FolderFiles

#: Longer than any file is old, so that a file delivered late is not passed over.
ANY_AGE = "36500d"


def start_ingest(
    ingestion: Ingestion,
    folder: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Ingest files as they arrive, corrected and renewed ones too, until stopped.

    ``trigger`` are the arguments of the stream's trigger; by default it takes what is
    there and ends. A micro-batch names the files that are new or changed; they go
    in by batches of ``files_per_batch``. One that is repeated after a crash changes
    nothing, as the ingestion log knows its files.
    """
    spark = ingestion.spark
    spark.dataSource.register(FolderFiles)
    checkpoint = checkpoint.rstrip("/")
    stream = spark.readStream.format(FORMAT).option("log", f"{checkpoint}/files").load(folder)

    def take(files: DataFrame, _: int) -> None:
        # As many names as a listing of the folder has that are new.
        paths = [row.path for row in files.select("path").distinct().orderBy("path").collect()]
        for at in range(0, len(paths), files_per_batch):
            ingestion.run_batch(paths[at : at + files_per_batch])

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{checkpoint}/stream")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def ingest_folder(
    ingestion: Ingestion, folder: str, files_per_batch: int = 1000, archive: str | None = None
) -> int:
    """Take in every ``*.csv`` directly in ``folder`` that the log does not know.

    A file stream remembers paths, so it would pass over a corrected file and new
    contents under a used name; here the folder is listed and joined with the
    log, which is the only memory. Batches follow path order and hold at most
    ``files_per_batch`` files; all are taken. Names starting with an underscore
    are skipped, and a file of no bytes is passed over until it has some. ``archive`` names a folder to which the files of a batch are
    moved after its commit, below the number of the batch. Returns the number of
    batches.
    """
    batches = 0
    while True:
        fresh = ingestion.unknown(listed(ingestion.spark, folder)).select("source_file")
        rows = fresh.orderBy("source_file").limit(files_per_batch).collect()
        if not rows:
            return batches
        paths = [row.source_file for row in rows]
        ingestion.run_batch(paths)
        batches += 1
        if archive:
            _move(ingestion, paths, f"{archive.rstrip('/')}/{ingestion.table.state().batch_id}")


def _move(ingestion: Ingestion, paths: list[str], folder: str) -> None:
    context = ingestion.spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path
    target = hadoop(folder)
    system = target.getFileSystem(context._jsc.hadoopConfiguration())
    system.mkdirs(target)
    for path in paths:
        source = hadoop(path)
        if not system.rename(source, hadoop(target, source.getName())):
            raise OSError(f"{path} could not be moved to {folder}")
