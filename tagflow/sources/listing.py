"""A data source of the files below a folder, listed in tasks: each reads some of the sub-folders.

The driver looks at the upper folders only. Names as Spark's file sources take them: those that begin with _ (without =) or . are
passed over. A filter that a path begins with a text leaves out the folders that cannot hold such a path before they are listed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, StringStartsWith

FORMAT = "tagflow_files"
SCHEMA = "path string, length long, modificationTime timestamp"
BATCH = 10_000


def opened(root: str) -> tuple[fs.FileSystem, str, str]:
    """(file system, root's path in it, what makes such a path one of Spark's)."""
    if "://" not in root:
        root = "file://" + root.removeprefix("file:")
    scheme = root.split("://")[0]
    system, path = fs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1) if scheme == "s3a" else root)
    if scheme == "hdfs":
        return system, path, f"hdfs://{root.split('://')[1].split('/')[0]}"
    return system, path.rstrip("/"), "file:" if scheme == "file" else f"{scheme}://"


def visible(name: str) -> bool:
    return not (name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"))


@dataclass
class Folders(InputPartition):
    """Folders to list; deep: with all below them."""

    paths: tuple[str, ...]
    deep: bool


class FilesReader(DataSourceReader):
    def __init__(self, root: str, recursive: bool, wanted: int) -> None:
        self.root, self.recursive, self.wanted = root, recursive, wanted
        self.starts: list[str] = []

    def _may_hold(self, path: str) -> bool:
        """Whether a folder may hold a path that begins as the filters want."""
        return all(f"{path}/".startswith(x) or x.startswith(f"{path}/") for x in self.starts)

    def _below(self, system: fs.FileSystem, folder: str) -> tuple[list[fs.FileInfo], list[str]]:
        """(files, folders) that are visible in a folder."""
        found = [x for x in system.get_file_info(fs.FileSelector(folder)) if visible(x.base_name)]
        return [x for x in found if x.type == fs.FileType.File], sorted(x.path for x in found if x.type == fs.FileType.Directory)

    def partitions(self) -> Sequence[InputPartition]:
        """Upper folders, opened until there are some for every task; an opened folder's own files are one partition's."""
        system, root, prefix = opened(self.root)
        if not self.recursive:
            return [Folders((root,), False)]
        flat, deep = [], [root]
        while deep and len(deep) < self.wanted:
            lower = [x for folder in deep for x in self._below(system, folder)[1] if self._may_hold(prefix + x)]
            flat += deep
            if not lower:
                deep = []
                break
            deep = lower
        each = max(1, len(deep) // (4 * self.wanted))
        return [Folders((x,), False) for x in flat] + [Folders(tuple(deep[i : i + each]), True) for i in range(0, len(deep), each)] or [Folders((), False)]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        system, _, prefix = opened(self.root)
        rows: list[fs.FileInfo] = []
        todo = list(partition.paths)
        while todo or rows:
            while todo and len(rows) < BATCH:
                files, folders = self._below(system, todo.pop())
                rows += files
                if partition.deep:
                    todo += [x for x in folders if self._may_hold(prefix + x)]
            part, rows = rows[:BATCH], rows[BATCH:]
            if part:
                stamp = [(x.mtime or datetime.fromtimestamp(0, UTC)) for x in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([prefix + x.path for x in part]), pa.array([x.size for x in part], pa.int64()), pa.array(stamp, pa.timestamp("us", "UTC"))], ["path", "length", "modificationTime"])


class PrunedFilesReader(FilesReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (StringStartsWith, EqualTo)) and f.attribute == ("path",) and isinstance(f.value, str):
                self.starts.append(f.value)
            yield f  # a folder that is kept holds other paths as well


class FilesSource(DataSource):
    """Options: path, recursive (true), partitions (about so many folders are opened up to), pushdown (whether the session lets filters through)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FilesReader:
        kind = PrunedFilesReader if self.options.get("pushdown") == "true" else FilesReader
        return kind(self.options["path"], self.options.get("recursive", "true") == "true", int(self.options.get("partitions", "64")))


def list_files(spark: SparkSession, root: str, recursive: bool = True, partitions: int = 64) -> DataFrame:
    """path, length, modificationTime of the files below root, which tasks list. root: a path that pyarrow.fs opens (file, s3, gs, hdfs).

    Where the session has spark.sql.python.filterPushdown.enabled, filters on the begin of path leave out whole folders.
    """
    spark.dataSource.register(FilesSource)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format(FORMAT).option("pushdown", pushdown).option("recursive", str(recursive).lower()).option("partitions", partitions).load(root)
