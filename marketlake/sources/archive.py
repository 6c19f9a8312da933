"""A data source for zipped CSV files, and digests of files of any size; both read files as streams.

    spark.dataSource.register(ArchiveSource)
    spark.read.format("csv_archive").option("columns", "id,price").load("/data/raw/BTC")

An archive is an input partition and is never held whole: the zip's member is decompressed and cut into rows as batches of
Arrow fill up. Files are opened through Arrow's file systems (local, HDFS, S3, GCS by URI); what only Spark's own file systems
reach goes through `readers.parse_archives`, whose cells hold a file.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

if TYPE_CHECKING:
    import pyarrow as pa
    from pyarrow.fs import FileSystem

#: Rows of a batch, and bytes of a file that a digest holds at a time.
ROWS, CHUNK = 50_000, 8 << 20


def file_system(path: str) -> tuple[FileSystem, str]:
    """The file system of a path or URI, and the path in it. Hadoop writes file:/a where a URI has file:///a."""
    from pyarrow.fs import FileSystem

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return FileSystem.from_uri(path)


def archives(path: str) -> list[str]:
    """The path itself, or the .zip files below it; a pattern in the last part of the path is matched."""
    from fnmatch import fnmatch

    from pyarrow.fs import FileSelector, FileType

    head, _, last = path.rpartition("/")
    pattern = last if any(c in last for c in "*?[") else None
    fs, at = file_system(head if pattern else path)
    info = fs.get_file_info(at)
    if info.type == FileType.File:
        return [path]
    found = [i for i in fs.get_file_info(FileSelector(at, recursive=pattern is None)) if i.type == FileType.File]
    names = sorted(i.path for i in found if fnmatch(i.path.rpartition("/")[2], pattern or "*.zip"))
    scheme = path.partition("://")[0] + "://" if "://" in path else ""
    if scheme and scheme != "file://":
        host = path[len(scheme) :].split("/")[0]
        return [f"{scheme}{n}" if n.startswith(host) else f"{scheme}{host}/{n.lstrip('/')}" for n in names]
    return names


class Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ArchiveSource(DataSource):
    """file, row_idx and the columns as text. Options: path; columns, by comma; first, rows of each file at most.

    A first line whose first cell is not all digits is a header. An archive without exactly one CSV and a line of another
    number of cells are errors. With `first`, a file is left at that row.
    """

    @classmethod
    def name(cls) -> str:
        return "csv_archive"

    def schema(self) -> str:
        return "file string, row_idx long, " + ", ".join(f"`{c.strip()}` string" for c in self.options["columns"].split(","))

    def reader(self, schema: object) -> ArchiveReader:
        return ArchiveReader(self.options)


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.columns = options["path"], [c.strip() for c in options["columns"].split(",")]
        self.first = int(options["first"]) if options.get("first") is not None else None

    def partitions(self) -> list[Archive]:
        found = archives(self.path)
        if not found:
            raise FileNotFoundError(f"no archives in {self.path}")
        return [Archive(p) for p in found]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        import csv
        import io
        import zipfile

        import pyarrow as pa

        fs, at = file_system(partition.path)
        schema = pa.schema([("file", pa.string()), ("row_idx", pa.int64()), *((c, pa.string()) for c in self.columns)])

        def batch(rows: list[list[str]], start: int) -> pa.RecordBatch:
            cells = [pa.array(c, pa.string()) for c in zip(*rows, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([partition.path] * len(rows), pa.string()), pa.array(range(start, start + len(rows)), pa.int64()), *cells], schema=schema)

        with fs.open_input_file(at) as raw, zipfile.ZipFile(raw) as z:
            inside = [n for n in z.namelist() if n.endswith(".csv")]
            if len(inside) != 1:
                raise ValueError(f"{partition.path}: one CSV expected, found {len(inside)}")
            held: list[list[str]] = []
            n = 0
            for k, line in enumerate(csv.reader(io.TextIOWrapper(z.open(inside[0]), "utf-8"))):
                if k == 0 and not line[0].isdigit():
                    continue
                if len(line) != len(self.columns):
                    raise ValueError(f"{partition.path}: {len(line)} columns, expected {len(self.columns)}")
                if self.first is not None and n >= self.first:
                    break
                held.append(line)
                n += 1
                if len(held) >= ROWS:
                    yield batch(held, n - len(held))
                    held = []
            if held:
                yield batch(held, n - len(held))


def digests(paths: DataFrame) -> DataFrame:
    """path, bytes, sha256 of files (column path), read in chunks: a task holds CHUNK bytes of a file, whatever its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for b in batches:
            names, sizes, found = b.column("path").to_pylist(), [], []
            for name in names:
                fs, at = file_system(name)
                h, n = hashlib.sha256(), 0
                with fs.open_input_stream(at, compression=None) as f:
                    while chunk := f.read(CHUNK):
                        h.update(chunk)
                        n += len(chunk)
                sizes.append(n)
                found.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(sizes, pa.int64()), pa.array(found, pa.string())], ["path", "bytes", "sha256"])

    return paths.select(F.col("path")).mapInArrow(run, "path string, bytes long, sha256 string")
