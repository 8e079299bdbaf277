"""A streaming data source of committed versions.

The offset of the stream is the number of a version, read from the table's commits: a version
that was refused, or whose write did not finish, has no commit and is never delivered, and one
that is written again is delivered once, as it was committed. A micro-batch's partitions are
the files of its versions, which do not change after their commit.

The source reads the table's folder with Arrow, on the driver for the commits and in tasks for
the rows, so the folder has to be in a store that Arrow opens (local or mounted paths, S3, GCS, HDFS).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

VERSION = "_commit_version"
#: Rows that a task reads and hands on at a time.
_ROWS = 8192


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of ``path`` and the path within it."""
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def data_files(store: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    """The parquet files right below ``folder``; none if there is no such folder."""
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted((f for f in found if f.type == fs.FileType.File and f.base_name.endswith(".parquet")
                   and not f.base_name.startswith(("_", "."))), key=lambda f: f.base_name)


class Commits:
    """The committed versions of a folder of commit rows; each file of them is read once."""

    def __init__(self, path: str):
        self.store, self.folder = opened(path)
        self.seen: set[str] = set()
        self.newest = 0

    def refresh(self) -> int:
        """Number of the newest committed version."""
        for file in data_files(self.store, self.folder):
            if file.base_name not in self.seen:
                rows = pq.read_table(file.path, columns=["version", "is_base"], filesystem=self.store).to_pylist()
                self.newest = max([self.newest, *(r["version"] for r in rows if not r["is_base"])])
                self.seen.add(file.base_name)
        return self.newest


@dataclass
class VersionFile(InputPartition):
    """A range of row groups in a file of a version."""

    path: str
    version: int
    groups: list[int]


class VersionReader(DataSourceStreamReader):
    """Rows of the versions ``start < v <= end``; see the module text."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path = options["path"].rstrip("/")
        self.start = int(options.get("start", "1"))
        self.most = int(options.get("maxversionspertrigger", options.get("maxVersionsPerTrigger", "0")))
        self.schema = schema
        self.commits = Commits(f"{self.path}/commits")
        self.reached: int | None = None  # unknown after a restart, whose first micro-batch then takes all there is

    def initialOffset(self) -> dict:
        self.reached = self.start - 1
        return {"version": self.reached}

    def latestOffset(self) -> dict:
        newest = max(self.commits.refresh(), self.start - 1)
        return {"version": min(newest, self.reached + self.most) if self.most and self.reached is not None else newest}

    def partitions(self, start: dict, end: dict) -> list[VersionFile]:
        store, root = opened(self.path)
        out = []
        for version in range(start["version"] + 1, end["version"] + 1):
            for file in data_files(store, f"{root}/changes/{VERSION}={version}"):
                groups = pq.ParquetFile(file.path, filesystem=store).metadata.num_row_groups
                out += [VersionFile(file.path, version, [g]) for g in range(groups)]
        self.reached = end["version"]
        return out

    def read(self, partition: VersionFile) -> Iterator[pa.RecordBatch]:
        store, _ = opened(self.path)
        target = to_arrow_schema(self.schema)
        file = pq.ParquetFile(partition.path, filesystem=store)
        names = [f.name for f in target if f.name != VERSION]
        for batch in file.iter_batches(batch_size=_ROWS, row_groups=partition.groups, columns=names):
            columns = [pa.array([partition.version] * len(batch), type=f.type) if f.name == VERSION else _cast(batch.column(f.name), f.type)
                       for f in target]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    def commit(self, end: dict) -> None:
        self.reached = end["version"]


def _cast(column: pa.Array, kind: pa.DataType) -> pa.Array:
    """Parquet's timestamps come in nanoseconds of UTC."""
    if pa.types.is_timestamp(column.type) and pa.types.is_timestamp(kind) and column.type != kind:
        if column.type.tz is None and kind.tz is not None:
            column = column.cast(pa.timestamp(column.type.unit, tz="UTC"))
        return column.cast(kind, safe=False)
    return column if column.type == kind else column.cast(kind)


class VersionSource(DataSource):
    """``spark.readStream.format("committed_versions")`` with the options path, start and maxVersionsPerTrigger."""

    @classmethod
    def name(cls) -> str:
        return "committed_versions"

    def streamReader(self, schema: StructType) -> VersionReader:
        return VersionReader(self.options, schema)


def version_stream(spark: SparkSession, path: str, schema: StructType, start: int = 1,
                   most_versions: int | None = None) -> DataFrame:
    """The rows of all versions from ``start`` as a stream; ``most_versions`` bounds a micro-batch."""
    spark.dataSource.register(VersionSource)
    reader = spark.readStream.format("committed_versions").schema(schema).option("path", path).option("start", str(start))
    if most_versions:
        reader = reader.option("maxVersionsPerTrigger", str(most_versions))
    return reader.load()
