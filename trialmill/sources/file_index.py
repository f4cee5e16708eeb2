"""Files of a folder as a data source whose tasks do the listing.

``spark.read.format("run_files").option("names", "result.json|grading.json").load(root)`` gives one row per file:
path (below ``root``), modified, size, content. The driver looks at the names of the first level only and deals
them out as ranges; a task lists what lies below its range and reads it. The driver holds two names per task,
however many files there are. Filters on ``path`` (equal, in, starts with) that Spark pushes down leave ranges and
folders out.

As a stream, the position is a time, the same for every range: a batch is what was modified after
the last position and up to the new one, so neither driver nor checkpoint keeps lists of files. ``settleSeconds`` is how
long after its modification time a file is surely visible. Files that arrive with an older time are not seen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, StringStartsWith
from pyspark.sql.types import StructType

FORMAT = "run_files"
SCHEMA = "path string, modified timestamp, size long, content string"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
PARTITIONS, BATCH_BYTES, SETTLE_SECONDS = 64, 8 << 20, 60


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The folder's file system and the path there; a path without a scheme is local or mounted."""
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder[5:])
    return fs.LocalFileSystem(), folder


@dataclass
class NameRange(InputPartition):
    """First-level names from ``first`` to ``last``, and the modification times (seconds) that are asked for."""

    first: str
    last: str
    after: float | None = None
    until: float | None = None

    def __post_init__(self):
        self.value = (self.first, self.last)


class FileIndex:
    """What reader and stream reader share: options, the first level, and a task's listing."""

    def __init__(self, schema: StructType, options: dict):
        self.names = schema.names
        self.root = options["path"]
        self.globs = options.get("names", "*").split("|")
        self.most = int(options.get("partitions", PARTITIONS))
        self.settle = float(options.get("settleSeconds", SETTLE_SECONDS))
        self.prefixes: list[tuple[str, ...]] = []  # a path must start with one of each

    def ranges(self) -> list[NameRange]:
        system, top = file_system(self.root)
        found = system.get_file_info(fs.FileSelector(top, allow_not_found=True))
        names = sorted(f.base_name for f in found if self.may_hold(f.base_name + ("/" if f.type == fs.FileType.Directory else "")))
        size = -(-len(names) // self.most) or 1
        return [NameRange(names[i], names[min(i + size, len(names)) - 1]) for i in range(0, len(names), size)]

    def may_hold(self, start: str) -> bool:
        """Whether a path that begins so can have the wanted beginnings."""
        return all(any(p.startswith(start) or start.startswith(p) for p in group) for group in self.prefixes)

    def wants(self, path: str) -> bool:
        name = path.rsplit("/", 1)[-1]
        return any(fnmatchcase(name, g) for g in self.globs) and all(path.startswith(group) for group in self.prefixes)

    def listed(self, part: NameRange) -> Iterator[tuple[fs.FileSystem, fs.FileInfo, str]]:
        """Wanted files below the range, folder by folder; folders that cannot hold any are not listed."""
        system, top = file_system(self.root)
        first = [f for f in system.get_file_info(fs.FileSelector(top)) if part.first <= f.base_name <= part.last]
        open_ = sorted(first, key=lambda f: f.path, reverse=True)
        while open_:
            info = open_.pop()
            path = info.path[len(top.rstrip("/")) + 1 :]
            if info.type == fs.FileType.Directory:
                if self.may_hold(path + "/"):
                    open_ += sorted(system.get_file_info(fs.FileSelector(info.path)), key=lambda f: f.path, reverse=True)
            elif self.wants(path):
                time = info.mtime_ns / 1e9
                if (part.after is None or time > part.after) and (part.until is None or time <= part.until):
                    yield system, info, path

    def read(self, partition: NameRange) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for system, info, path in self.listed(partition):
            with system.open_input_stream(info.path, compression=None) as f:
                content = f.read().decode("utf-8", "replace")
            rows.append((path, info.mtime.astimezone(dt.timezone.utc), info.size, content))
            held += len(content) + 200
            if held > BATCH_BYTES:
                yield self.batch(rows)
                rows, held = [], 0
        if rows:
            yield self.batch(rows)

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=self.names)


class FileReader(FileIndex, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return self.ranges() or [NameRange("", "")]


class PushingFileReader(FileReader):
    """The reader of sessions in which Spark hands filters to Python data sources."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for found in filters:
            known = getattr(found, "attribute", None) == ("path",) and isinstance(found, (EqualTo, In, StringStartsWith))
            if known:
                self.prefixes.append(tuple(found.value) if isinstance(found, In) else (found.value,))
            if not (known and isinstance(found, StringStartsWith)):
                yield found  # a beginning is not yet the whole path


class FileStreamReader(FileIndex, DataSourceStreamReader):
    """Positions by time: what was modified up to ``until`` has been read in every range of names."""

    def initialOffset(self) -> dict:
        return {"until": 0.0}

    def latestOffset(self) -> dict:
        return {"until": dt.datetime.now().timestamp() - self.settle}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [NameRange(r.first, r.last, start["until"], end["until"]) for r in self.ranges()] or [NameRange("", "")]

    def commit(self, end: dict) -> None:
        """Nothing is kept between batches."""

    def stop(self) -> None:
        """Nothing is open between batches."""


class RunFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        pushed = str(self.options.get("pushdown", "false")).lower() == "true"
        return (PushingFileReader if pushed else FileReader)(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return FileStreamReader(schema, self.options)


def indexed_files(spark: SparkSession, root: str, *names: str, partitions: int = PARTITIONS) -> DataFrame:
    """path (below ``root``), modified, size and content of the files with one of the names, as :func:`read_files` gives."""
    spark.dataSource.register(RunFiles)
    options = {"names": "|".join(names or ("*",)), "partitions": partitions, "pushdown": spark.conf.get(PUSHDOWN, "false")}
    return spark.read.format(FORMAT).options(**options).load(root)


def file_stream(spark: SparkSession, root: str, *names: str, settle_seconds: float = SETTLE_SECONDS, partitions: int = PARTITIONS) -> DataFrame:
    """The same files as a stream, each once after its last modification."""
    spark.dataSource.register(RunFiles)
    options = {"names": "|".join(names or ("*",)), "partitions": partitions, "settleSeconds": settle_seconds}
    return spark.readStream.format(FORMAT).options(**options).load(root)
