"""A data source for files that Spark's scans cannot open as they are.

Partitions are planned from a listing by bytes: small files share one, large plain files are cut, a file
with a codec is one stream.  Tasks read in steps of a few megabytes, so no file is ever held as a whole.
The streaming twin keeps the names it has handed out in a log of its own.
"""

from __future__ import annotations

import gzip
import json
import posixpath
import re
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from millrace.session import active, most_tasks
from millrace.sources import names
from millrace.sources.codecs import document_array, line_arrays
from millrace.sources.names import LARGE, is_data, is_streamed

FORMAT = "millrace_files"
ROW_TYPE = "value string, source struct<path:string,offset:bigint,length:bigint,total:bigint>"
STEP = 4 * 1024 * 1024
#: Bytes of a partition without a ``size``.
SPLIT = 64 * 1024 * 1024
#: What a file costs beside its bytes.
OPEN_COST = 1024 * 1024

# How a gzip member and an lz4 frame begin.
_GZIP_MAGIC, _LZ4_MAGIC = b"\x1f\x8b", b"\x04\x22\x4d\x18"


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and its name there; an error if only Hadoop knows it."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/(?!/)", "file:///", root)))


@dataclass(frozen=True)
class Found:
    name: str
    size: int
    changed: int


def listed(root: str, threads: int = 16) -> Iterator[Found]:
    """Every file below ``root`` (or ``root`` itself), folders side by side, names relative to it."""
    store, base = opened(root)
    base = base.rstrip("/")
    top = store.get_file_info(base or "/")
    if top.type == fs.FileType.File:
        yield Found(posixpath.basename(base), top.size, top.mtime_ns or 0)
        return
    with ThreadPoolExecutor(threads) as pool:
        folders = [base] if top.type == fs.FileType.Directory else []
        while folders:
            below = []
            for found in pool.map(lambda f: store.get_file_info(fs.FileSelector(f or "/")), folders):
                for info in found:
                    if info.type == fs.FileType.Directory:
                        below.append(info.path)
                    else:
                        yield Found(info.path.removeprefix(base + "/"), info.size, info.mtime_ns or 0)
            folders = [f for f in below if is_data(f.removeprefix(base + "/"))]


@dataclass(frozen=True)
class Pieces(InputPartition):
    """Byte ranges (root, name, start, end, size of the file) that one task reads."""

    ranges: tuple[tuple[str, str, int, int, int], ...] = ()


@dataclass(frozen=True)
class Settings:
    roots: tuple[str, ...]
    compression: str
    delimiter: bytes
    whole: bool
    split: int
    large: int = LARGE
    #: partitions, beyond which one takes more than ``split`` bytes
    most: int = 1 << 62

    @classmethod
    def of(cls, options) -> "Settings":
        given = json.loads(options["settings"])
        return cls(tuple(given["roots"]), given["compression"], given["delimiter"].encode(), given["whole"], given["split"] or SPLIT, given["large"], given["most"])

    def wanted(self, found: Found) -> bool:
        return is_streamed(found.name, found.size, self.compression, self.whole, self.large)

    def cut(self, found: Found) -> list[tuple[int, int]]:
        """The ranges of a file: one if it is decoded, a document, or has lines that cannot be found from inside."""
        mark = self.delimiter
        overlaps = any(mark.startswith(mark[k:]) for k in range(1, len(mark)))
        if found.size == 0:
            return []
        if self.whole or self.compression != "none" or overlaps or self._may_be_coded(found.name):
            return [(0, found.size)]
        return [(at, min(at + self.split, found.size)) for at in range(0, found.size, self.split)]

    @staticmethod
    def _may_be_coded(name: str) -> bool:
        return name.endswith((".gz", ".lz4"))

    def planned(self, files: Iterable[tuple[str, Found]]) -> list[Pieces]:
        """Ranges packed in listing order, a partition being full at ``split`` bytes, or at an equal share."""
        ranges = [(root, found.name, start, end, found.size) for root, found in files for start, end in self.cut(found)]
        parts = self._packed(ranges, self.split + OPEN_COST)
        if len(parts) > self.most:
            parts = self._packed(ranges, -(-sum(end - start + OPEN_COST for _, _, start, end, _ in ranges) // self.most))
        return parts

    @staticmethod
    def _packed(ranges: list[tuple[str, str, int, int, int]], full: int) -> list[Pieces]:
        parts, held, filled = [], [], 0
        for piece in ranges:
            cost = piece[3] - piece[2] + OPEN_COST
            if held and filled + cost > full:
                parts.append(Pieces(tuple(held)))
                held, filled = [], 0
            held.append(piece)
            filled += cost
        return parts + [Pieces(tuple(held))] * bool(held)


def _line_start(stream, at: int, mark: bytes, size: int) -> int:
    """Where the first line begins that begins at ``at`` or after it."""
    if at <= 0 or at >= size:
        return min(max(at, 0), size)
    place = max(0, at - len(mark))
    stream.seek(place)
    held = b""
    while chunk := stream.read(64 * 1024):
        held += chunk
        found = held.find(mark)
        if found >= 0:
            return place + found + len(mark)
        keep = len(mark) - 1
        place += len(held) - keep
        held = held[len(held) - keep :]
    return size


def _steps(stream, start: int, end: int) -> Iterator[bytes]:
    stream.seek(start)
    while start < end and (chunk := stream.read(min(STEP, end - start))):
        start += len(chunk)
        yield chunk


def _decoded(stream, codec: str) -> Iterator[bytes]:
    with gzip.GzipFile(fileobj=stream) if codec == "gzip" else pa.CompressedInputStream(stream, "lz4") as plain:
        while chunk := plain.read(STEP):
            yield chunk


def _codec(stream, settings: Settings, name: str) -> str:
    """The codec of the settings; without one, that of the name if the bytes begin like it."""
    if settings.compression != "none":
        return settings.compression
    magic = stream.read(4)
    stream.seek(0)
    if name.endswith(".gz") and magic.startswith(_GZIP_MAGIC):
        return "gzip"
    return "lz4" if name.endswith(".lz4") and magic == _LZ4_MAGIC else "none"


def read_pieces(settings: Settings, part: Pieces) -> Iterator[pa.RecordBatch]:
    """The lines (or documents) that begin in the ranges of ``part``, a few megabytes at a time."""
    for root, name, start, end, size in part.ranges:
        store, base = opened(root)
        at_root = store.get_file_info(base).type == fs.FileType.File
        path = base if at_root else posixpath.join(base, name)
        shown = f"file://{path}" if isinstance(store, fs.LocalFileSystem) else (root if at_root else posixpath.join(root, name))
        with store.open_input_file(path) as stream:
            codec = _codec(stream, settings, name)
            if codec != "none":
                chunks = _decoded(stream, codec)
            elif settings.whole:
                chunks = _steps(stream, 0, size)
            else:
                first = _line_start(stream, start, settings.delimiter, size)
                chunks = _steps(stream, first, _line_start(stream, end, settings.delimiter, size))
            for lines in [document_array(chunks)] if settings.whole else line_arrays(chunks, settings.delimiter):
                origin = [pa.repeat(pa.scalar(shown), len(lines)), *(pa.repeat(pa.scalar(x, pa.int64()), len(lines)) for x in (start, end - start, size))]
                source = pa.StructArray.from_arrays(origin, ["path", "offset", "length", "total"])
                yield pa.RecordBatch.from_arrays([lines, source], names=["value", "source"])


class FileReader(DataSourceReader):
    def __init__(self, settings: Settings):
        self.settings = settings

    def partitions(self) -> list[InputPartition]:
        files = ((root, found) for root in self.settings.roots for found in listed(root) if self.settings.wanted(found))
        return self.settings.planned(files) or [Pieces()]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        return read_pieces(self.settings, partition)


class Log:
    """Numbered entries with the files that came; each name is in one of them.

    An entry is written under another name and then moved, so it is there as a whole or not at all.
    """

    def __init__(self, folder: str):
        self._store, self._base = opened(folder)
        self._store.create_dir(self._base, recursive=True)

    def numbers(self) -> list[int]:
        found = self._store.get_file_info(fs.FileSelector(self._base))
        return sorted(int(m[1]) for f in found if (m := re.fullmatch(r"(\d+)\.json", f.base_name)))

    def entry(self, number: int) -> list[tuple[str, Found]]:
        with self._store.open_input_stream(f"{self._base}/{number}.json") as stream:
            return [(root, Found(*found)) for root, *found in map(json.loads, stream.read().splitlines())]

    def add(self, number: int, files: list[tuple[str, Found]]) -> None:
        rows = "\n".join(json.dumps([root, f.name, f.size, f.changed]) for root, f in files)
        staged = f"{self._base}/.{number}-{uuid.uuid4().hex}"
        with self._store.open_output_stream(staged) as stream:
            stream.write(rows.encode())
        self._store.move(staged, f"{self._base}/{number}.json")


class FileStream(DataSourceStreamReader):
    """Offsets count the entries of the log, so what a batch holds is the same after a restart."""

    def __init__(self, settings: Settings, folder: str):
        self.settings, self.folder = settings, folder
        self._known: set[tuple[str, str]] | None = None
        self._last = 0

    def _catch_up(self, log: Log) -> set[tuple[str, str]]:
        if self._known is None:
            self._known = set()
        for number in log.numbers():
            if number > self._last:
                self._known |= {(root, found.name) for root, found in log.entry(number)}
                self._last = number
        return self._known

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        log = Log(self.folder)
        known = self._catch_up(log)
        new = [(root, f) for root in self.settings.roots for f in listed(root) if self.settings.wanted(f) and (root, f.name) not in known]
        if new:
            log.add(self._last + 1, sorted(new, key=lambda x: (x[1].changed, x[1].name)))
            self._catch_up(log)
        return {"entry": self._last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        log = Log(self.folder)
        files = [found for number in range(start["entry"] + 1, end["entry"] + 1) for found in log.entry(number)]
        return self.settings.planned(files) or [Pieces()]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        return read_pieces(self.settings, partition)


class FileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ROW_TYPE

    def reader(self, schema) -> FileReader:
        return FileReader(Settings.of(self.options))

    def streamReader(self, schema) -> FileStream:
        return FileStream(Settings.of(self.options), self.options["log"])


def streamed_lines(
    spark: SparkSession, roots: Iterable[str], *, compression: str, delimiter: str, whole: bool, size: int | None, log: str | None = None
) -> DataFrame:
    """``value, source`` of the files that ``is_streamed`` names; a stream if there is a folder for its ``log``."""
    settings = json.dumps({"roots": list(roots), "compression": compression, "delimiter": delimiter, "whole": whole, "split": size, "large": names.LARGE, "most": most_tasks(spark) if size else 1 << 62})
    with active(spark):
        # a session keeps what was registered first
        if not spark._jsparkSession.sessionState().dataSourceManager().dataSourceExists(FORMAT):
            spark.dataSource.register(FileSource)
        reader = spark.read if log is None else spark.readStream.option("log", log)
        return reader.format(FORMAT).option("settings", settings).load()
