"""Landed response pages as a Spark data source: ``spark.read.format("landed_pages")``.

A page stands on one line of a text file, as ``{"results": [record, …], "total_count": n}``. A
partition is a range of pages: the pages whose lines begin in one range of bytes of one file, so that a
large file is read by many tasks. The options ``from`` and ``to`` bound ``local_time`` (as text, the end
excluded); records outside are left out before they leave the Python worker. Bounds are options
because a source that takes over Spark's filters keeps them for later queries of the same DataFrame
(seen with 4.1.2), which then lose rows.

As a stream, the offset is the modification time and the name of the last file taken in, and a batch
holds the files that landed since. A file must be whole when it appears, with a time of its own.

Options: ``path`` (a folder or file that all workers see), ``pageBytes`` (bytes of a partition, 32 MiB
by default). Unreadable lines give no rows; the ingest steps set them aside. Names that begin with a
dot or an underscore are passed over.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from loamline.schemas import SOIL_RECORD

FORMAT = "landed_pages"
TIME = "local_time"
PAGE_BYTES = 32 << 20
ROWS = 4096

Bounds = tuple[str | None, str | None]


@dataclass
class PageRange(InputPartition):
    """The pages whose lines begin at ``start`` or later and before ``stop``."""

    path: str
    start: int
    stop: int


def opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def landed(path: str) -> list[fs.FileInfo]:
    """Files of a folder and its subfolders, in the order in which they landed."""
    system, place = opened(path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.File:
        return [info]
    found = system.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True))
    files = [f for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._"]
    return sorted(files, key=place_in_time)


def place_in_time(info: fs.FileInfo) -> tuple[int, str]:
    return info.mtime_ns or 0, info.path


def ranges(files: Iterable[fs.FileInfo], page_bytes: int) -> list[PageRange]:
    return [
        PageRange(f.path, at, min(at + page_bytes, f.size))
        for f in files
        for at in range(0, f.size, page_bytes)
    ]


def lines_in(system: fs.FileSystem, part: PageRange) -> Iterator[bytes]:
    """The lines that begin in a range; the last one is read to its end beyond it."""
    with system.open_input_file(part.path) as raw, pa.PythonFile(raw, mode="r") as file:
        at = part.start
        if at:
            # A line that began before belongs to the range before, one that begins here to this one.
            file.seek(at - 1)
            at += len(_line(file)) - 1
        while at < part.stop:
            line = _line(file)
            if not line:
                return
            at += len(line)
            yield line


def _line(file: pa.NativeFile) -> bytes:
    """One line with its end, in pieces of any length."""
    pieces = []
    while True:
        start = file.tell()
        piece = file.read(1 << 16)
        end = piece.find(b"\n")
        if end >= 0:
            file.seek(start + end + 1)
            pieces.append(piece[: end + 1])
            return b"".join(pieces)
        pieces.append(piece)
        if not piece:
            return b"".join(pieces)


def records_in(line: bytes, names: Sequence[str], bounds: Bounds) -> Iterator[tuple]:
    """Records of a page as rows of text, those with a time within the bounds."""
    try:
        page = json.loads(line)
    except ValueError:
        return
    results = page.get("results") if isinstance(page, dict) else None
    for record in results if isinstance(results, list) else ():
        if isinstance(record, dict):
            if within(as_text(record.get(TIME)), bounds):
                yield tuple(as_text(record.get(name)) for name in names)


def as_text(value: object) -> str | None:
    """A cell as the text that Spark's JSON reader takes it for."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def bounds_of(options: dict[str, str]) -> Bounds:
    return options.get("from"), options.get("to")


def within(value: str | None, bounds: Bounds) -> bool:
    start, end = bounds
    if start is None and end is None:
        return True
    return value is not None and (start is None or value >= start) and (end is None or value < end)


class PageReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.names = schema.fieldNames()
        self.path = options["path"]
        self.page_bytes = int(options.get("pagebytes", PAGE_BYTES))
        self.bounds = bounds_of(options)

    def partitions(self) -> Sequence[PageRange]:
        return ranges(landed(self.path), self.page_bytes)

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        return batches(opened(self.path)[0], partition, self.names, self.bounds)


def batches(
    system: fs.FileSystem, part: PageRange, names: Sequence[str], bounds: Bounds
) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for line in lines_in(system, part):
        rows.extend(records_in(line, names, bounds))
        if len(rows) >= ROWS:
            yield batch_of(rows, names)
            rows = []
    if rows:
        yield batch_of(rows, names)


def batch_of(rows: list[tuple], names: Sequence[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, pa.string()) for column in zip(*rows)], names=list(names)
    )


class PageStreamReader(DataSourceStreamReader):
    """Files by the time at which they landed; a file must not change once it is there."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.names = schema.fieldNames()
        self.path = options["path"]
        self.page_bytes = int(options.get("pagebytes", PAGE_BYTES))
        self.bounds = bounds_of(options)

    def initialOffset(self) -> dict:
        return {"time": -1, "name": ""}

    def latestOffset(self) -> dict:
        """The place of the file that landed last."""
        files = landed(self.path)
        time, name = place_in_time(files[-1]) if files else (-1, "")
        return {"time": time, "name": name}

    def partitions(self, start: dict, end: dict) -> Sequence[PageRange]:
        after, until = (start["time"], start["name"]), (end["time"], end["name"])
        return ranges([f for f in landed(self.path) if after < place_in_time(f) <= until], self.page_bytes)

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        return batches(opened(self.path)[0], partition, self.names, self.bounds)

    def commit(self, end: dict) -> None:
        """Nothing is kept for files that have been taken in."""


class LandedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return SOIL_RECORD

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(schema, {k.lower(): v for k, v in self.options.items()})

    def streamReader(self, schema: StructType) -> PageStreamReader:
        return PageStreamReader(schema, {k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    """Make the format known to a session.

    Sources are planned in Python processes of their own, which need not have this library, so the
    classes travel as they are.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LandedPages)


def _options(start: str | None, end: str | None, page_bytes: int) -> dict[str, str]:
    given = {"from": start, "to": end, "pageBytes": str(page_bytes)}
    return {name: value for name, value in given.items() if value is not None}


def read_landed(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    page_bytes: int = PAGE_BYTES,
) -> DataFrame:
    """Records of landed pages, as text, in the columns of a page record, with times in [start, end)."""
    register(spark)
    return spark.read.format(FORMAT).options(**_options(start, end, page_bytes)).load(path)


def stream_landed(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    page_bytes: int = PAGE_BYTES,
) -> DataFrame:
    """The same as a stream."""
    register(spark)
    return spark.readStream.format(FORMAT).options(**_options(start, end, page_bytes)).load(path)
