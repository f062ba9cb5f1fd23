"""Versions of files as a stream: a file that is written anew is a new record (ST1, S1).

Spark's own file source knows a file by its path and never reads it again.  This
source lists a folder and compares it with a log of versions, (path, modification
time, length), that it keeps beside the checkpoint: what isn't in the log is appended
to it as one numbered entry, and an offset is the number of an entry.  An entry that
was written but not yet read when the stream stopped is read on restart; one that was
read is never listed again.
"""

from __future__ import annotations

import json
import posixpath
import re
import time
from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "path string, version long, length long, content binary"
FORMAT = "file_versions"
_ARROW = pa.schema([("path", pa.string()), ("version", pa.int64()), ("length", pa.int64()), ("content", pa.binary())])
#: Other names of stores that the file systems of Arrow know.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def open_folder(uri: str):
    """File system and path of a folder."""
    from pyarrow import fs

    scheme, mark, rest = uri.partition("://")
    if not mark and re.match(r"[a-z]+:/", uri):
        return open_folder(re.sub(r"^([a-z]+):/+", r"\1:///", uri))
    if not mark:
        return fs.LocalFileSystem(), uri.rstrip("/")
    files, path = fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")
    return files, path.rstrip("/")


class VersionLog:
    """Numbered entries, each a list of ``[path, version, length]``."""

    def __init__(self, folder: str) -> None:
        self.files, self.folder = open_folder(folder)

    def numbers(self) -> list[int]:
        from pyarrow import fs

        found = self.files.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        names = (posixpath.basename(f.path) for f in found)
        return sorted(int(m[1]) for m in (re.fullmatch(r"(\d+)\.json", n) for n in names) if m)

    def read(self, number: int) -> list[list]:
        with self.files.open_input_file(f"{self.folder}/{number:012d}.json") as file:
            return json.loads(file.read())

    def append(self, entry: list[list]) -> int:
        """The entry gets its name once it is whole."""
        number = max(self.numbers(), default=0) + 1
        self.files.create_dir(self.folder, recursive=True)
        waiting = f"{self.folder}/{number:012d}.part"
        with self.files.open_output_stream(waiting) as file:
            file.write(json.dumps(entry, ensure_ascii=False).encode())
        self.files.move(waiting, f"{self.folder}/{number:012d}.json")
        return number


class Group(InputPartition):
    """Versions that one task reads."""

    def __init__(self, versions: list[list]) -> None:
        self.versions = versions


class FileVersionReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder, self.pattern = options["path"], options.get("pattern", "*")
        self.most = int(options.get("filesPerBatch", 0))
        self.bytes_per_task = int(options.get("bytesPerTask", 64 << 20))
        self.log_folder, self.pause = options["log"], float(options.get("secondsBetween", 1))
        self._seen: dict[str, list] | None = None
        self._last, self._waiting, self._next = 0, [], 0.0

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        """The last entry of the log, after what has changed in the folder is appended to it."""
        log = VersionLog(self.log_folder)
        if self._seen is None:
            self._seen = {}
            for number in log.numbers():
                self._seen |= {path: rest for path, *rest in log.read(number)}
                self._last = number
        if not self._waiting and time.monotonic() >= self._next:
            found = ([path, *rest] for path, *rest in self._listed() if self._seen.get(path) != rest)
            self._waiting = sorted(found, key=lambda v: (v[1], v[0]))
            self._next = time.monotonic() + self.pause
        most = self.most or len(self._waiting)
        new, self._waiting = self._waiting[:most], self._waiting[most:]
        if new:
            self._last = log.append(new)
            self._seen |= {path: rest for path, *rest in new}
        return {"entry": self._last}

    def _listed(self) -> Iterator[list]:
        from pyarrow import fs

        files, folder = open_folder(self.folder)
        for info in files.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True)):
            if info.is_file and any(fnmatch(info.base_name, p) for p in self.pattern.split(",")):
                yield [info.path, info.mtime_ns // 1000, info.size]

    def partitions(self, start: dict, end: dict) -> list[Group]:
        """The entries after ``start``; of a file that has several, the last one alone."""
        log = VersionLog(self.log_folder)
        last = {path: rest for n in range(start["entry"] + 1, end["entry"] + 1) for path, *rest in log.read(n)}
        groups, size = [], self.bytes_per_task
        for path, (version, length) in sorted(last.items()):
            if size + length > self.bytes_per_task:
                groups.append([])
                size = 0
            groups[-1].append([path, version, length])
            size += length
        return [Group(g) for g in groups]

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        """One file after the other; one that has vanished since comes without content."""
        files, _ = open_folder(self.folder)
        for path, version, length in partition.versions:
            try:
                with files.open_input_file(path) as file:
                    content = file.read()
            except FileNotFoundError:
                content = None
            columns = [pa.array([v], f.type) for v, f in zip((path, version, length, content), _ARROW)]
            yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)


class FileVersions(DataSource):
    """``path, version, length, content``; options ``path``, ``log``, ``pattern``, ``filesPerBatch``, ``bytesPerTask``, ``secondsBetween``.

    ``version`` is the modification time in microseconds.  ``filesPerBatch`` bounds a batch
    of a stream that goes on; a run through what is there (``availableNow``) is one batch.
    The folder is listed every ``secondsBetween`` at most.  The driver holds one entry for each file of the folder, as for any listing.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> FileVersionReader:
        return FileVersionReader(self.options)
