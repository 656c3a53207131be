"""Bucketed tables of versions, append-only logs and reports on plain Parquet."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.merge import concat, keep_last
from millrace.sources.commits import CommitLog, Folder

#: A commit has a ``file`` row per ingested or rejected file, and a ``base`` or ``delta``
#: row per bucket that it wrote (with no folder if the bucket is empty now).
COMMITS = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("missing_columns", T.ArrayType(T.StringType())),
        T.StructField("modified", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("keys_unique", T.BooleanType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("folder", T.StringType()),
        T.StructField("properties", T.StringType()),
    ]
)

#: Of the ``file`` rows, what a caller gives; further columns of these names are optional.
FILES = ("source_file", "n_rows", "status", "missing_columns", "modified", "length")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table at ``path``, or no rows while nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def latest(df: DataFrame, order: str) -> DataFrame:
    """The one row with the greatest ``order``; no rows give no row."""
    top = df.agg(F.max_by(F.struct(*df.columns), F.col(order)).alias("r"))
    return top.where("r is not null").select("r.*")


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Store one batch's rows; writing the same batch again replaces them."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


class TableState(NamedTuple):
    """Current version (None before the first), unique keys or not, last batch (or -1)."""

    version: int | None
    keys_unique: bool
    batch_id: int


class Written(NamedTuple):
    """Buckets written beside the table, waiting for their commit."""

    kind: str
    name: str
    folders: dict[int, str | None]
    keys_unique: bool
    properties: str


class _Layout(NamedTuple):
    """Where the rows of one version lie: a base folder and delta folders per bucket."""

    properties: dict
    base: dict[int, str | None]
    deltas: dict[int, list[str]]

    def folders(self) -> set[str]:
        return {f for f in self.base.values() if f} | {f for fs in self.deltas.values() for f in fs}


class BucketedTable:
    """A table in hash buckets of its key, changed by deltas and read merged.

    A version is, per bucket, a base folder and the delta folders after it. An upsert
    writes one row per changed key into deltas of the buckets touched; nothing else is
    written or read. Reading takes buckets without deltas as they are; in the others
    the rows of the base whose keys the deltas hold give way to the newest of these.
    Compaction is a job of its own: it writes buckets with deltas anew as a base; it also runs
    by itself for buckets of more than ``most_deltas``, so reads stay bounded.

    Data are written into fresh folders named by the commit, which becomes current when its
    rows land in the log as one file. A crash before that leaves every version as it was. The
    last ``keep`` versions stay readable; each commit deletes folders that none of them
    needs. There is one writer.

    ``key``, ``order`` (which of two rows of a key is the later one) and ``buckets`` are
    fixed when the table starts and are then read from it. Take as many buckets as
    make one a good task, say a gigabyte.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str | None = None,
        order: Sequence[str] = (),
        buckets: int = 16,
        keep: int = 3,
        most_deltas: int = 8,
        snapshot_every: int = 20,
    ):
        if keep < 1:
            raise ValueError("the current version is kept at least")
        self.spark = spark
        self.path = path.rstrip("/")
        self.keep, self.most_deltas = keep, most_deltas
        self._given = {"key": key, "order": list(order), "buckets": buckets}
        self._data = Folder(spark, f"{self.path}/data")
        self.log = CommitLog(spark, f"{self.path}/log", COMMITS, snapshot_every, self._pruned)

    # --- what the log says

    def commits(self) -> DataFrame:
        """One row per ingested or rejected file."""
        return self.log.read().where("kind = 'file'")

    def state(self) -> TableState:
        row = self.log.read().agg(
            F.max("version").alias("version"),
            F.max_by("keys_unique", F.when(F.col("keys_unique").isNotNull(), F.col("version"))).alias("unique"),
            F.max("batch_id").alias("batch_id"),
        ).first()
        return TableState(row.version, bool(row.unique), -1 if row.batch_id is None else row.batch_id)

    def ingestion_log(self) -> DataFrame:
        """What was ingested or rejected, and when."""
        return self.commits().select("ingested_at", "source_file", "n_rows", "status", "missing_columns")

    def _layouts(self) -> dict[int, _Layout]:
        """The layout of each readable version; rows as many as buckets and kept folders."""
        rows = self.log.read().where("kind <> 'file'").select("version", "kind", "bucket", "folder", "properties")
        changes: dict[int, list] = {}
        for row in rows.collect():
            changes.setdefault(row.version, []).append(row)
        now, found = _Layout({}, {}, {}), {}
        for version in sorted(changes):
            rows = changes[version]
            base, deltas = dict(now.base), dict(now.deltas)
            if len(rows) == json.loads(rows[0].properties)["buckets"] and rows[0].kind == "base":
                base, deltas = {}, {}
            for row in rows:
                if row.kind == "base":
                    base[row.bucket] = row.folder
                    deltas.pop(row.bucket, None)
                elif row.folder:
                    deltas[row.bucket] = [*deltas.get(row.bucket, []), row.folder]
            now = _Layout(json.loads(rows[0].properties), base, deltas)
            found[version] = now
        return {version: found[version] for version in sorted(found)[-self.keep :]}

    def _current(self) -> _Layout | None:
        layouts = self._layouts()
        return layouts[max(layouts)] if layouts else None

    def _pruned(self, rows: DataFrame) -> DataFrame:
        """Without the folders that no readable version needs."""
        layouts = self._layouts()
        if not layouts:
            return rows
        oldest = min(layouts)
        # Of older versions only what the oldest readable one still consists of.
        needed = F.col("folder").isin(list(layouts[oldest].folders()))
        return rows.where((F.col("kind") == "file") | (F.col("version") >= oldest) | needed)

    # --- reading

    def _scan(self, layout: _Layout, folders: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(layout.properties["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(self._data.at(f) for f in folders))

    def _merged(self, layout: _Layout, buckets: list[int]) -> DataFrame:
        """The rows of some buckets, deltas applied."""
        plain = [b for b in buckets if not layout.deltas.get(b)]
        rows = self._scan(layout, [layout.base[b] for b in plain if layout.base.get(b)])
        changed = [b for b in buckets if layout.deltas.get(b)]
        if not changed:
            return rows
        key, order = layout.properties["key"], layout.properties["order"]
        newest = self._scan(layout, [f for b in changed for f in layout.deltas[b]])
        if any(len(layout.deltas[b]) > 1 for b in changed):
            newest = keep_last(newest, key, order)
        replaced = newest.select(F.col(key).alias("_key"))
        base = self._scan(layout, [layout.base[b] for b in changed if layout.base.get(b)])
        kept = base.join(replaced, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
        return concat(rows, kept, newest)

    def read(self, version: int | None = None) -> DataFrame:
        layouts = self._layouts()
        if not layouts:
            raise ValueError(f"nothing committed yet in {self.path}")
        version = max(layouts) if version is None else version
        if version not in layouts:
            raise ValueError(f"version {version} is not kept; the current one is {max(layouts)}")
        layout = layouts[version]
        return self._merged(layout, sorted({*layout.base, *layout.deltas}))

    # --- writing

    def stage(self, df: DataFrame) -> DataFrame:
        """Write a batch beside the table once, to be read several times."""
        path = f"{self.path}/staging"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _write(self, df: DataFrame, kind: str, unique: bool, properties: dict, wanted: Sequence[int]) -> Written:
        """Rows into a folder per bucket; ``wanted`` are the buckets a base replaces."""
        name = f"{kind}-{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64(properties["key"]), F.lit(properties["buckets"])).cast("int")
        # Spark joins small buckets in a task and deals large ones out to several.
        placed = df.withColumn("_bucket", bucket).hint("rebalance", "_bucket")
        placed.write.partitionBy("_bucket").parquet(self._data.at(name))
        folders: dict[int, str | None] = dict.fromkeys(wanted)
        for part in self._data.names(name):
            if part.startswith("_bucket="):
                folders[int(part.removeprefix("_bucket="))] = f"{name}/{part}"
        return Written(kind, name, folders, unique, json.dumps(properties))

    def _properties(self, layout: _Layout | None, df: DataFrame) -> dict:
        """Those of the table, with the columns that ``df`` adds to it."""
        own = dict(layout.properties) if layout else {**self._given, "schema": {"type": "struct", "fields": []}}
        if not own["key"]:
            raise ValueError("a new table needs a key")
        known = {f["name"] for f in own["schema"]["fields"]}
        fresh = [{**f.jsonValue(), "nullable": True} for f in df.schema.fields if f.name not in known]
        own["schema"] = {"type": "struct", "fields": [*own["schema"]["fields"], *fresh]}
        return own

    def replace(self, df: DataFrame, keys_unique: bool = True) -> Written:
        """The rows as the whole table."""
        layout = self._current()
        properties = self._properties(layout, df)
        properties["schema"] = json.loads(df.schema.json())
        return self._write(df, "base", keys_unique, properties, range(properties["buckets"]))

    def upsert(self, df: DataFrame) -> Written:
        """The last row per key takes the place of the table's row with that key.

        ``df`` comes later in ``order`` than the table. While the table may hold a key twice
        (it was seeded so), it is written anew as a whole.
        """
        layout = self._current()
        properties = self._properties(layout, df)
        key, order = properties["key"], properties["order"]
        if layout is None or not self.state().keys_unique:
            rows = concat(self.read(), df) if layout else df
            return self._write(keep_last(rows, key, order), "base", True, properties, range(properties["buckets"]))
        return self._write(keep_last(df, key, order), "delta", True, properties, ())

    def commit(self, files: DataFrame | None = None, written: Written | None = None, batch_id: int | None = None) -> None:
        """Log the files of a batch and what was written; this switches readers over."""
        version = self.state().version
        if written and not written.folders:
            written = None  # no row, no new version
        if written:
            version = 0 if version is None else version + 1
            rows = self.spark.createDataFrame(list(written.folders.items()), "bucket int, folder string").select(
                "*", F.lit(written.kind).alias("kind"), F.lit(written.properties).alias("properties"),
                F.lit(written.keys_unique).alias("keys_unique"),
            )
        else:
            rows = self.spark.createDataFrame([], "kind string")
        if files is not None:
            present = [c for c in FILES if c in files.columns]
            rows = rows.unionByName(files.select(F.lit("file").alias("kind"), *present), allowMissingColumns=True)
        given = {"version": F.lit(version), "batch_id": F.lit(batch_id), "ingested_at": F.current_timestamp()}
        given |= {n: F.lit(None) for n in COMMITS.names if n not in rows.columns and n not in given}
        rows = rows.withColumns(given)
        self.log.append(rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in COMMITS.fields)))
        if written:
            layouts = self._layouts()
            self._delete_outdated(layouts)
            if written.kind == "delta":
                self._compact(layouts[max(layouts)], self.most_deltas + 1)

    def compact(self, least_deltas: int = 1) -> int:
        """Write the buckets that have so many deltas anew; the number of these."""
        layout = self._current()
        return self._compact(layout, least_deltas) if layout else 0

    def _compact(self, layout: _Layout, least_deltas: int) -> int:
        buckets = sorted(b for b, folders in layout.deltas.items() if len(folders) >= least_deltas)
        if buckets:
            rows = self._merged(layout, buckets)
            self.commit(written=self._write(rows, "base", True, layout.properties, buckets))
        return len(buckets)

    def _delete_outdated(self, layouts: dict[int, _Layout]) -> None:
        """Folders that no readable version needs, uncommitted ones among them."""
        needed: dict[str, set[str]] = {}
        for layout in layouts.values():
            for folder in layout.folders():
                name, part = folder.split("/")
                needed.setdefault(name, set()).add(part)
        for name in self._data.names():
            if name not in needed:
                self._data.delete(name)
                continue
            for part in self._data.names(name):
                if part.startswith("_bucket=") and part not in needed[name]:
                    self._data.delete(f"{name}/{part}")
