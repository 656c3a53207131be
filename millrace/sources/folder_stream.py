"""A streaming source of the files in a folder, known by path, time and length.

Spark's own file source knows a file by its path alone, so it passes over a corrected
file and new contents under a used name, and it expands patterns in names. This source
is a Python data source, ``spark.readStream.format("folder_files")``, with the rows
(path, modified, length) of files that are new or changed:

* ``path``: the folder, taken literally; ``log``: a folder for the source's own memory.
* An offset is a number of entries in that log. Each new offset lists the folder once,
  compares with the log and adds what is new as one entry, a small JSON file renamed into
  place; so an offset means the same files for ever, and a stream that restarts from its
  checkpoint reads an interrupted batch again with the same rows.
* Names starting with an underscore or a point and files of no bytes are passed over.

Files are listed, not opened, through pyarrow's file systems (local, HDFS, object
stores). The driver holds a digest per known file, as Spark's source holds a path.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from fnmatch import fnmatchcase

import pyarrow.fs as fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "folder_files"
_ROWS_PER_TASK = 10_000


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


class _Entry(InputPartition):
    def __init__(self, number: int, first: int, stop: int):
        super().__init__(None)
        self.number, self.first, self.stop = number, first, stop


class FolderReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.log = options["path"].rstrip("/"), options["log"].rstrip("/")
        self.pattern = options.get("pattern", "*.csv")
        self._known: set[bytes] = set()
        self._entries = 0

    @staticmethod
    def _digest(file: list) -> bytes:
        return hashlib.blake2b(json.dumps(file).encode(), digest_size=16).digest()

    def _entry(self, number: int) -> list[list]:
        system, log = _opened(self.log)
        with system.open_input_stream(f"{log}/{number:010d}.json") as file:
            return json.loads(file.read())

    def _catch_up(self) -> None:
        """Read the entries this reader has not seen; all of them after a restart."""
        system, log = _opened(self.log)
        selector = fs.FileSelector(log, allow_not_found=True)
        written = [i for i in system.get_file_info(selector) if i.base_name[:-5].isdigit()]
        for number in range(self._entries, len(written)):
            self._known.update(map(self._digest, self._entry(number)))
        self._entries = max(self._entries, len(written))

    def _listed(self) -> Iterator[list]:
        system, folder = _opened(self.folder)
        for info in system.get_file_info(fs.FileSelector(folder)):
            hidden = info.base_name.startswith(("_", "."))
            if info.is_file and info.size and not hidden and fnmatchcase(info.base_name, self.pattern):
                yield [f"{self.folder}/{info.base_name}", info.mtime_ns // 1_000_000, info.size]

    def initialOffset(self) -> dict:
        return {"entries": 0}

    def latestOffset(self) -> dict:
        self._catch_up()
        fresh = sorted(f for f in self._listed() if self._digest(f) not in self._known)
        if fresh:
            system, log = _opened(self.log)
            system.create_dir(log, recursive=True)
            aside = f"{log}/_{uuid.uuid4().hex}"
            with system.open_output_stream(aside) as file:
                file.write(json.dumps(fresh).encode())
            system.move(aside, f"{log}/{self._entries:010d}.json")
            self._known.update(map(self._digest, fresh))
            self._entries += 1
        return {"entries": self._entries}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [
            _Entry(number, first, first + _ROWS_PER_TASK)
            for number in range(start["entries"], end["entries"])
            for first in range(0, len(self._entry(number)), _ROWS_PER_TASK)
        ]

    def read(self, partition: _Entry) -> Iterator[tuple]:
        for path, modified, length in self._entry(partition.number)[partition.first : partition.stop]:
            yield path, datetime.fromtimestamp(modified / 1000, timezone.utc), length


class FolderFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, modified timestamp, length long"

    def streamReader(self, schema) -> FolderReader:
        return FolderReader(dict(self.options))
