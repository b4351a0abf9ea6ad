"""Files as a Spark data source: every file of a folder is a row, whatever its name.

Spark's own file sources leave out names that begin with ``_`` or ``.`` and read brackets as patterns. This
one lists folders itself, opens each path literally, and plans its partitions by file size. A file over ``limitBytes``
is a row without content, and is never opened; one that can't be read is a row without content too. Comparisons of
``length`` and of ``path`` are applied to the listing, before anything is opened.

As a stream it numbers batches of files that are new. What belongs to a batch is written to the ``ledger`` folder
before its number is given out, so a batch that runs again has the same files.
"""

from __future__ import annotations

import fnmatch
import json
import os
import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow.fs import FileInfo, FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark import cloudpickle
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith,
)

NAME = "gridloom_archives"
SCHEMA = "path string, length long, modified timestamp, content binary"
#: Bytes of contents in one Arrow batch, or a single file.
BATCH_BYTES = 4 << 20
ARROW = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modified", pa.timestamp("us", "UTC")), ("content", pa.binary())])
PATTERN = re.compile(r"[*?\[\]{}]")


def located(address: str) -> tuple[FileSystem, str, str]:
    """The file system, the literal path there, and what its paths are prefixed with in results."""
    scheme, colon, rest = address.partition(":")
    if not colon or "/" in scheme:
        return LocalFileSystem(), os.path.abspath(address), "file:"
    if scheme == "file":
        return LocalFileSystem(), "/" + rest.lstrip("/"), "file:"
    authority, _, path = rest.removeprefix("//").partition("/")
    system, root = FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, f"{root.rstrip('/')}/{path}", f"{scheme}://{authority}" if root == "/" else f"{scheme}://"


def spelled(pattern: str) -> list[str]:
    """A glob without its alternatives ``{a,b}``, which may be nested."""
    found = re.search(r"\{([^{}]*)\}", pattern)
    return [pattern] if not found else [p for part in found[1].split(",") for p in spelled(pattern[: found.start()] + part + pattern[found.end() :])]


def matching(system: FileSystem, pattern: str) -> Iterator[FileInfo]:
    """What a glob names: only folders on the way to it are listed."""
    for one in spelled(pattern):
        parts = one.split("/")
        first = next((i for i, p in enumerate(parts) if PATTERN.search(p)), len(parts))
        places = [system.get_file_info("/".join(parts[:first]) or "/")]
        for part in parts[first:]:
            fits = re.compile(fnmatch.translate(part)).match
            places = [f for p in places if p.type == FileType.Directory for f in system.get_file_info(FileSelector(p.path)) if fits(f.base_name)]
        yield from places


@dataclass
class File(InputPartition):
    """A file as the listing has it; ``place`` is its path in the file system."""

    place: str
    path: str
    length: int
    modified: int


def listed(address: str, recursive: bool, suffix: str) -> list[File]:
    """A file of any suffix, the files of a folder that end in ``suffix`` in any case, or those of a glob."""
    system, place, prefix = located(address)
    start = system.get_file_info(place)
    if start.type == FileType.NotFound and PATTERN.search(place):
        starts, any_suffix = list(matching(system, place)), False
    else:
        starts, any_suffix = [start], True
    found: dict[str, FileInfo] = {}
    for at in starts:
        below = system.get_file_info(FileSelector(at.path, recursive=recursive)) if at.type == FileType.Directory else [at] if at.type == FileType.File else []
        single = at.type == FileType.File and any_suffix
        found.update({f.path: f for f in below if f.type == FileType.File and (single or f.base_name.lower().endswith(suffix))})
    return [File(p, f"{prefix}{p}", f.size, f.mtime_ns // 1000) for p, f in sorted(found.items())]


def planned(files: list[File], partition_bytes: int, open_bytes: int, parallelism: int) -> list[Files]:
    """Partitions of about equal bytes, each file counting ``open_bytes`` more; the largest files first."""
    total = sum(f.length + open_bytes for f in files)
    most = min(partition_bytes, max(open_bytes, total // max(parallelism, 1)))
    parts, held = [], 0
    for f in sorted(files, key=lambda f: (-f.length, f.path)):
        if not parts or held + f.length > most:
            parts.append([])
            held = 0
        parts[-1].append(f)
        held += f.length + open_bytes
    return [Files(tuple(p)) for p in parts]


@dataclass
class Files(InputPartition):
    files: tuple[File, ...]


def content(system: FileSystem, file: File, limit: int | None) -> bytes | None:
    if limit is not None and file.length > limit:
        return None
    try:
        with system.open_input_stream(file.place) as stream:
            return stream.read()
    except OSError:
        return None


def batches(address: str, files: tuple[File, ...], limit: int | None) -> Iterator[pa.RecordBatch]:
    system = located(address)[0]
    rows, held = [], 0
    for file in files:
        data = content(system, file, limit)
        if rows and held + len(data or b"") > BATCH_BYTES:
            yield _batch(rows)
            rows, held = [], 0
        rows.append((file.path, file.length, datetime.fromtimestamp(file.modified / 1e6, timezone.utc), data))
        held += len(data or b"")
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


#: What a pushed filter asks of a file.
TESTS: dict[type, Callable] = {
    EqualTo: lambda have, value: have == value, In: lambda have, value: have in value, LessThan: lambda have, value: have < value, LessThanOrEqual: lambda have, value: have <= value,
    GreaterThan: lambda have, value: have > value, GreaterThanOrEqual: lambda have, value: have >= value, StringStartsWith: lambda have, value: have.startswith(value),
    StringEndsWith: lambda have, value: have.endswith(value), StringContains: lambda have, value: value in have,
}


class _Options:
    def __init__(self, options):
        self.address = options["path"]
        self.recursive = options.get("recursive", "true").lower() == "true"
        self.suffix = options.get("suffix", ".mhtml").lower()
        self.limit = int(options["limitBytes"]) if "limitBytes" in options else None
        self.plan = (int(options.get("partitionBytes", 128 << 20)), int(options.get("openBytes", 4 << 20)), int(options.get("parallelism", 1)))
        self.ledger, self.at_a_time = options.get("ledger"), int(options.get("filesAtATime", 1000))

    def files(self) -> list[File]:
        return listed(self.address, self.recursive, self.suffix)


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.options, self.tests = _Options(options), []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if type(f) in TESTS and f.attribute in (("path",), ("length",)) and f.value is not None:
                self.tests.append((f.attribute[0], TESTS[type(f)], f.value))
            else:
                yield f

    def partitions(self) -> list[Files]:
        files = [f for f in self.options.files() if all(test(getattr(f, name), value) for name, test, value in self.tests)]
        return planned(files, *self.options.plan) or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return batches(self.options.address, partition.files, self.options.limit)


class ArchiveStream(DataSourceStreamReader):
    """Offsets are numbers of batches; the ledger has a file of paths for each."""

    def __init__(self, options):
        self.options = _Options(options)
        self.system, self.folder, _ = located(self.options.ledger)
        self.seen: dict[str, int] = {}
        self.known = 0

    def initialOffset(self) -> dict:  # noqa: N802
        return {"batch": 0}

    def _place(self, batch: int) -> str:
        return f"{self.folder}/{batch:012d}.json"

    def _of(self, batch: int) -> list[File]:
        with self.system.open_input_stream(self._place(batch)) as stream:
            return [File(*f) for f in json.loads(stream.read())]

    def latestOffset(self) -> dict:  # noqa: N802
        self.system.create_dir(self.folder)
        while self.system.get_file_info(self._place(self.known + 1)).type == FileType.File:
            self.known += 1
            self.seen.update({f.path: f.modified for f in self._of(self.known)})
        new = [f for f in self.options.files() if self.seen.get(f.path) != f.modified]
        new = sorted(new, key=lambda f: (f.modified, f.path))[: self.options.at_a_time]
        if new:
            waiting = f"{self.folder}/.{self.known + 1:012d}"
            with self.system.open_output_stream(waiting) as out:
                out.write(json.dumps([[f.place, f.path, f.length, f.modified] for f in new]).encode())
            self.system.move(waiting, self._place(self.known + 1))
            self.known += 1
            self.seen.update({f.path: f.modified for f in new})
        return {"batch": self.known}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        files = [f for batch in range(start["batch"] + 1, end["batch"] + 1) for f in self._of(batch)]
        return planned(files, *self.options.plan) or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return batches(self.options.address, partition.files, self.options.limit)


class ArchiveSource(DataSource):
    """``path`` (file, folder or glob), ``recursive``, ``suffix``, ``limitBytes``; for streams ``ledger`` and ``filesAtATime``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)

    def streamReader(self, schema) -> ArchiveStream:  # noqa: N802
        return ArchiveStream(self.options)


def registered(spark) -> str:
    """The source's name, known to the session. Its code goes by value: the process that plans a stream gets no files that were added to the session."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ArchiveSource)
    return NAME
