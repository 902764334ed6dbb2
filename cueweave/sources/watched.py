"""A folder of subtitle files as a stream: every file once, and again whenever it changes.

Spark's own file streams know a file by its path and never look at it again. Here the offset is a modification time, so a run
takes the files that are newer than the last run's end; a batch is planned into partitions of about the same bytes.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

PATTERNS, PARTITION_BYTES = "*.srt,*.SRT,*.ass,*.ASS", 64 << 20


@dataclass
class FileGroup(InputPartition):
    paths: list[tuple[str, int]]  # (path, modification time in nanoseconds)


class ChangedFiles(DataSourceStreamReader):
    """Files of a folder (not of those below it) by modification time."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.patterns = options.get("patterns", PATTERNS).split(",")
        self.most = int(options.get("partitionbytes", PARTITION_BYTES))

    def _store(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.path) if ":" in self.path.split("/")[0] else (pafs.LocalFileSystem(), self.path)

    def _files(self) -> list[pafs.FileInfo]:
        fs, root = self._store()
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        return [f for f in found if f.type == pafs.FileType.File and any(fnmatch.fnmatchcase(f.base_name, p) for p in self.patterns)]

    def initialOffset(self) -> dict:  # noqa: N802  Spark's name
        return {"newest": -1}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"newest": max((f.mtime_ns for f in self._files()), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        new = sorted((f for f in self._files() if start["newest"] < f.mtime_ns <= end["newest"]), key=lambda f: (-f.size, f.path))
        groups: list[tuple[int, list[tuple[str, int]]]] = []
        for f in new:  # the largest first, each to the first group that has room
            k = next((i for i, (size, _) in enumerate(groups) if size + f.size <= self.most), None)
            if k is None:
                groups.append((f.size, [(f.path, f.mtime_ns)]))
            else:
                groups[k] = (groups[k][0] + f.size, [*groups[k][1], (f.path, f.mtime_ns)])
        return [FileGroup(paths) for _, paths in groups]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fs, _ = self._store()
        for path, at in partition.paths:
            if fs.get_file_info(path).type != pafs.FileType.File:
                continue  # it has gone since
            name = path.rsplit("/", 1)[-1]
            with fs.open_input_file(path) as f:
                yield name, name.rsplit(".", 1)[-1].lower(), bytearray(f.read()), at

    def commit(self, end: dict) -> None:
        """Nothing is kept for batches that are done."""


class WatchedFiles(DataSource):
    """format("watched_files"): options path, patterns (names, separated by commas) and partitionBytes."""

    @classmethod
    def name(cls) -> str:
        return "watched_files"

    def schema(self) -> str:
        return "file string, format string, raw binary, mtime_ns long"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return ChangedFiles(self.options)


def watch(spark: SparkSession, folder: str, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """A stream of file, format, raw and mtime_ns of the subtitle files of a folder, new and changed ones. A file that is written to
    twice within a batch comes as it is when it is read; a file that gets an older time than the last batch's newest is not seen."""
    spark.dataSource.register(WatchedFiles)
    return spark.readStream.format("watched_files").option("path", folder).option("partitionBytes", str(partition_bytes)).load()
