"""Files of any length as captured rows: a data source whose partitions are byte ranges.

``binaryFile`` puts a whole file into one row, so it ends at 2 GiB and one task reads it. Here a
file is cut into rows of ``rangeBytes``, and partitions take about ``partitionBytes`` of them: a long
file is read by many tasks, many short files by one.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tidegate.session import ship_package

RANGE_BYTES = 1 << 20
PARTITION_BYTES = 64 << 20
#: stream_id is the file's path, seq numbers its ranges from 0, ts is when it was last written.
COLUMNS = {
    "stream_id": "STRING",
    "seq": "BIGINT",
    "ts": "TIMESTAMP",
    "n_bytes": "BIGINT",
    "payload": "BINARY",
}
_ARROW = {
    "stream_id": pa.string(),
    "seq": pa.int64(),
    "ts": pa.timestamp("us", tz="UTC"),
    "n_bytes": pa.int64(),
    "payload": pa.binary(),
}
_BATCH_BYTES = 8 << 20
_READ_BYTES = 1 << 20


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it; plain paths and ``file:`` are local or mounted folders."""
    local = re.match(r"file:/+(.*)", path, re.DOTALL)
    if local or "://" not in path:
        return fs.LocalFileSystem(), f"/{local[1]}" if local else path
    return fs.FileSystem.from_uri(path)


class _Ranges(InputPartition):
    """Pieces of files: (path within the file system, time, first and last byte)."""

    def __init__(self, pieces: list[tuple[str, dt.datetime, int, int]]):
        self.pieces = pieces


class ByteRangeReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path = options["path"]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.columns = schema.names
        self.names = options.get("pathGlobFilter", "*")
        unknown = set(self.columns) - set(COLUMNS)
        if unknown or self.range_bytes < 1:
            raise ValueError(f"no such columns, or rangeBytes below 1: {sorted(unknown)}")

    def partitions(self) -> list[_Ranges]:
        """Ranges as the files are now: bytes that are appended later are not read."""
        system, root = _file_system(self.path)
        info = system.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info] if info.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
        # Names that start with "_" or "." belong to writers, as in Spark's own sources.
        hidden = re.compile(r"(?:^|/)[_.]")
        files = [f for f in files if f.is_file and not hidden.search(f.path[len(root) :] if f is not info else "")]
        pieces, size, out = [], 0, []
        step = max(1, self.partition_bytes // self.range_bytes) * self.range_bytes
        for file in sorted(files, key=lambda f: f.path):
            if not fnmatch.fnmatchcase(file.base_name, self.names):
                continue
            time = file.mtime or dt.datetime.fromtimestamp(0, dt.timezone.utc)
            # A file without bytes is one range without bytes.
            for start in range(0, max(1, file.size), step):
                end = min(start + step, file.size)
                pieces.append((file.path, time, start, end))
                size += end - start
                if size >= step or len(pieces) >= 10_000:
                    out.append(_Ranges(pieces))
                    pieces, size = [], 0
        if pieces or not out:
            out.append(_Ranges(pieces))
        return out

    def read(self, partition: _Ranges) -> Iterator[pa.RecordBatch]:
        rows: dict[str, list] = {name: [] for name in COLUMNS}
        held = 0
        for row in self._rows(partition):
            for name, value in zip(COLUMNS, row):
                rows[name].append(value)
            held += len(row[-1] or b"")
            if held >= _BATCH_BYTES or len(rows["seq"]) >= 10_000:
                yield self._batch(rows)
                rows, held = {name: [] for name in COLUMNS}, 0
        if rows["seq"]:
            yield self._batch(rows)

    def _rows(self, partition: _Ranges) -> Iterator[tuple]:
        system, _ = _file_system(self.path)
        # Many short ranges of a file come with one read.
        block = max(1, _READ_BYTES // self.range_bytes) * self.range_bytes
        for path, time, start, end in partition.pieces:
            file = system.open_input_file(path) if "payload" in self.columns else None
            try:
                held, held_at = b"", start
                for at in range(start, max(end, start + 1), self.range_bytes):
                    n = min(self.range_bytes, end - at)
                    if file and at + n > held_at + len(held):
                        held, held_at = file.read_at(min(block, end - at), at), at
                    data = held[at - held_at : at - held_at + n] if file else None
                    if file and len(data) < n:
                        raise OSError(f"{path} was cut while it was read")
                    yield path, at // self.range_bytes, time, n, data
            finally:
                if file:
                    file.close()

    def _batch(self, rows: dict[str, list]) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array(rows[c], _ARROW[c]) for c in self.columns], names=list(self.columns)
        )


class ByteRangeSource(DataSource):
    """Options: ``path`` (file or folder), ``rangeBytes`` (of a row), ``partitionBytes``, ``pathGlobFilter``.

    Filters are not pushed into the reader: Spark 4.1 leaves those of one query in force for the next
    one on the same DataFrame. ``pathGlobFilter`` leaves files out instead.
    """

    @classmethod
    def name(cls) -> str:
        return "byte_ranges"

    def schema(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in COLUMNS.items())

    def reader(self, schema: StructType) -> ByteRangeReader:
        return ByteRangeReader(self.options, schema)


def read_ranges(
    spark: SparkSession,
    path: str,
    range_bytes: int = RANGE_BYTES,
    partition_bytes: int = PARTITION_BYTES,
    columns: tuple[str, ...] = tuple(COLUMNS),
    names: str = "*",
) -> DataFrame:
    """Rows ``(stream_id, seq, ts, n_bytes, payload)`` of a file, or of all files below a folder.

    Without ``payload`` among ``columns`` no file is opened: the rows follow from the listing. A file
    without bytes is one row without bytes. ``names`` is a glob that file names must match. The path is a
    mounted or local folder, or a store that Arrow reads (``s3://``, ``gs://``, ``hdfs://``).
    """
    ship_package(spark)
    spark.dataSource.register(ByteRangeSource)
    schema = ", ".join(f"{name} {COLUMNS[name]}" for name in columns)
    reader = spark.read.format(ByteRangeSource.name()).schema(schema)
    options = {"rangeBytes": range_bytes, "partitionBytes": partition_bytes, "pathGlobFilter": names}
    return reader.options(**options).load(path)
