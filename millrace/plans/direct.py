"""Files written under their final names, for stores where a rename is a copy.

Each task opens ``<id>.<n><ending>`` itself; ``n`` counts the task attempts of the application, so no two
attempts ever share a name.
The names go to a list that the attempt keeps in the log of slices and begins before its first file.  The driver
gets the number of the attempt with the commit message, removes what attempts without a message have left, and
notes the numbers; it moves nothing, and holds no names.
"""

from __future__ import annotations

import io
import json
import posixpath
import re
from collections.abc import Container, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from millrace.session import active
from millrace.sources.files import opened
from millrace.sources.inventory import names_below

FORMAT = "millrace_direct"
#: The k-th further file of a task has a number that is higher by so much: more than an application has attempts.
FURTHER = 10**9
# Lines are handed to a file in steps of about this many bytes, so its bound is kept closely.
_STEP_BYTES = 1 << 20
# What the codecs are called in Arrow.
_CODECS = {"gzip": "gzip", "lz4": "lz4"}


@dataclass
class Written(WriterCommitMessage):
    #: that of the attempt; None if it had no rows
    number: int | None
    records: int


@dataclass(frozen=True)
class Target:
    """Where and how files are written; ``manifest`` is where the driver notes the attempts that are part of it."""

    path: str
    id: str
    ending: str
    compression: str
    delimiter: str
    array: bool
    header: str | None
    routed: bool
    route_prefix: str
    records_per_file: int | None
    bytes_per_file: int | None
    #: what is added to the number of an attempt, and the first number that only this slice can have
    offset: int
    low: int
    manifest: str

    def name(self, folder: str, number: int) -> str:
        return posixpath.join(folder, f"{self.id}.{number}{self.ending}")

    def list_name(self, number: int) -> str:
        return list_name(self.manifest, number)


def list_name(manifest: str, number: int) -> str:
    """Where an attempt lists its files: one json text in a line."""
    return f"{manifest.removesuffix('.files')}.{number}.files"


def listed_names(body: bytes | str) -> Iterator[str]:
    return map(json.loads, body.splitlines())


def begun_attempts(manifest: str) -> list[int]:
    """The numbers of all attempts that have begun a list."""
    store, place = opened(manifest)
    pattern = re.compile(re.escape(posixpath.basename(place).removesuffix(".files")) + r"\.(\d+)\.files\Z")
    found = store.get_file_info(fs.FileSelector(posixpath.dirname(place), allow_not_found=True))
    return [int(m[1]) for info in found if (m := pattern.match(info.base_name))]


class _File:
    """One output file while it grows; only a few megabytes of it are in memory."""

    def __init__(self, store: fs.FileSystem, path: str, target: Target):
        self._raw = store.open_output_stream(path, compression=None)  # names do not decide
        codec = _CODECS.get(target.compression)
        self._out = pa.CompressedOutputStream(self._raw, codec) if codec else self._raw
        self._array, self._mark = target.array, target.delimiter.encode()
        self.records = self.size = 0
        if target.header is not None and not target.array:
            self._write(target.header.encode() + self._mark)

    def _write(self, data) -> None:
        self._out.write(data)
        self.size += len(data)

    def add(self, values: pa.Array) -> None:
        whole = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(pa.binary()))
        joined = pc.binary_join(whole, b"," if self._array else self._mark)[0].as_buffer()
        if self._array:
            self._write(b"," if self.records else b"[")
        self._write(joined)
        if not self._array:
            self._write(self._mark)
        self.records += len(values)

    def close(self) -> None:
        if self._array:
            self._write(b"]" + self._mark)
        self._out.close()
        self._raw.close()


def route_folder(value: str | None, prefix: str) -> str:
    """The folder of a route below the path; ``prefix`` is ``<column>=`` for folders that name their column."""
    if value is None or not value.strip("/"):
        return ""
    if prefix:
        # Characters that Spark writes as %XX in the names of such folders.
        return prefix + "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\\x7f{[]^" or c < " " else c for c in value)
    if ".." in value.split("/"):
        raise ValueError(f"route {value!r} leaves the target folder")
    folder = posixpath.normpath(value).strip("/")
    return "" if folder == "." else folder


def _runs(batch: pa.RecordBatch, routed: bool) -> Iterator[tuple[str | None, pa.Array]]:
    """The values of a batch, by stretches of one route."""
    values = batch.column(0)
    if not routed:
        if len(values):
            yield None, values
        return
    coded = pc.run_end_encode(batch.column(1).fill_null(""))
    start = 0
    for route, end in zip(coded.values.to_pylist(), coded.run_ends.to_pylist()):
        yield route, values.slice(start, end - start)
        start = end


class DirectWriter(DataSourceArrowWriter):
    def __init__(self, target: Target):
        self.target = target

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        target = self.target
        store, base = opened(target.path)
        first = number = target.offset + TaskContext.get().taskAttemptId()
        listing, records = None, 0
        body, current = None, None
        for batch in iterator:
            for route, values in _runs(batch, target.routed):
                if body is not None and route != current:
                    body.close()
                    body = None
                current = route
                step = max(1, _STEP_BYTES * len(values) // max(1, values.nbytes))
                at = 0
                while at < len(values):
                    if body is None:
                        folder = route_folder(route, target.route_prefix)
                        if listing is None:
                            listing = self._list(first)
                        name = target.name(folder, number)
                        listing.write(json.dumps(name).encode() + b"\n")
                        number += FURTHER
                        if isinstance(store, fs.LocalFileSystem):
                            store.create_dir(posixpath.join(base, folder), recursive=True)
                        body = _File(store, posixpath.join(base, name), target)
                    room = (target.records_per_file or 1 << 62) - body.records
                    some = values.slice(at, min(step, room))
                    body.add(some)
                    at, records = at + len(some), records + len(some)
                    if body.records >= (target.records_per_file or 1 << 62) or body.size >= (target.bytes_per_file or 1 << 62):
                        body.close()
                        body = None
        if body is not None:
            body.close()
        if listing is None:
            return Written(None, 0)
        listing.close()
        return Written(first, records)

    def _list(self, number: int):
        """The list of an attempt; it can be seen before the first file is there, also where files appear when closed."""
        store, place = opened(self.target.list_name(number))
        store.open_output_stream(place, compression=None).close()
        return store.open_output_stream(place, compression=None, buffer_size=1 << 16)

    def commit(self, messages: list[Written | None]) -> None:
        done = [m for m in messages if m is not None and m.number is not None]
        numbers = sorted(m.number for m in done)
        self._remove_others(set(numbers))
        store, place = opened(self.target.manifest)
        with store.open_output_stream(place) as out:
            out.write(json.dumps({"numbers": numbers, "records": sum(m.records for m in done)}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        self._remove_others(set())

    def _remove_others(self, numbers: set[int]) -> None:
        target = self.target
        lost = set(begun_attempts(target.manifest)) - numbers
        if lost:
            remove_unlisted(target.path, target.id, target.ending, lost, set())
            for number in lost:
                store, place = opened(target.list_name(number))
                store.delete_file(place)


def remove_unlisted(path: str, id: str, ending: str, attempts: Container[int], kept: set[str], but: Container[int] = ()) -> None:
    """Remove files of the id that these attempts made, ``but`` for some, and that are not ``kept``: left by attempts that lost."""
    store, base = opened(path)
    pattern = re.compile(re.escape(id) + r"\.(\d+)" + re.escape(ending) + r"\Z")
    for name in names_below(path):
        match = pattern.match(posixpath.basename(name))
        if match and name not in kept and (number := int(match[1]) % FURTHER) in attempts and number not in but:
            store.delete_file(posixpath.join(base, name))


def remove_listed(spark: SparkSession, path: str, lists: list[str]) -> None:
    """Remove the files that stand in lists of attempts, each list in a task of its own."""
    if not lists:
        return

    def run(batches):
        store, base = opened(path)
        for place in (place for batch in batches for place in batch.column(0).to_pylist()):
            with opened(place)[0].open_input_stream(opened(place)[1], compression=None) as stream:
                for line in io.BufferedReader(stream):
                    try:
                        store.delete_file(posixpath.join(base, json.loads(line)))
                    except FileNotFoundError:
                        pass
        yield from ()

    spark.createDataFrame([(x,) for x in lists], "place string").repartition(len(lists)).mapInArrow(run, "place string").collect()


class DirectSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> DirectWriter:
        return DirectWriter(Target(**json.loads(self.options["target"])))


def write_direct(rows: DataFrame, target: Target) -> None:
    """Write ``value`` (and the route behind it, if there is one) of all rows; the manifest tells the files."""
    spark = rows.sparkSession
    with active(spark):
        if not spark._jsparkSession.sessionState().dataSourceManager().dataSourceExists(FORMAT):
            spark.dataSource.register(DirectSink)
        rows.write.format(FORMAT).mode("append").option("target", json.dumps(target.__dict__)).save()
