"""What lies below a path: a listing in rounds, without opening a file."""

from __future__ import annotations

import datetime
import os
import posixpath
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.paths import is_readable_path
from millrace.session import Files, scratch_folder
from millrace.sources.check import SourceError
from millrace.sources.files import opened

_LISTED = "key string, size long, modified timestamp"
_ENTRY = "key string, folder boolean, size long, modified timestamp"
#: Files that a task looks at, where names come without size and time.
_LOOKED_AT = 500
#: Tasks of a round, and of that look; what a task holds does not depend on how many files it has.
_TASKS = 2_000
#: Entries that leave a task at a time.
_ROWS = 10_000


def _is_bookkeeping(key: str) -> bool:
    """Files that are nobody's data: those that Hadoop keeps beside a local file, and the log of slices."""
    *folders, name = key.split("/")
    logged = name.endswith((".slice", ".files")) and folders and folders[-1].startswith(".") and folders[-1].endswith(".slices")
    return bool(logged) or (name.startswith(".") and name.endswith(".crc"))


def _entries(store: fs.FileSystem, base: str, folder: str):
    """(key, folder, size, modified) of what is directly in a folder; local names come alone, one by one."""
    place = posixpath.join(base, folder)
    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(place) as found:
            for entry in found:
                yield posixpath.join(folder, entry.name), entry.is_dir(), None, None
        return
    for info in store.get_file_info(fs.FileSelector(place)):
        yield posixpath.join(folder, info.base_name), info.type == fs.FileType.Directory, info.size, info.mtime


def names_below(root: str) -> Iterator[str]:
    """The files below a path, relative to it, one by one; a local folder may hold any number of them."""
    store, base = opened(root)
    folders = [""]
    while folders:
        try:
            for key, is_folder, _, _ in _entries(store, base, folders.pop()):
                if is_folder:
                    folders.append(key)
                else:
                    yield key
        except FileNotFoundError:  # removed by another job since it was seen
            continue


def _in_batches(rows, schema: pa.Schema):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_TIME = pa.timestamp("us", "UTC")


def listed_in_rounds(spark: SparkSession, root: str) -> DataFrame:
    """(key, size, modified) of all files below ``root``, by rounds over tables of folders.

    A round lists the folders of the one before, each in one of many tasks, and stores what it finds; the
    folders in it are the next round.  The driver sees counts only.  Local names come without size and time:
    those are looked at afterwards, in as many tasks as the number of files asks for.
    """
    schema = pa.schema([("key", pa.string()), ("folder", pa.bool_()), ("size", pa.int64()), ("modified", _TIME)])

    def below(batches):
        store, base = opened(root)
        for batch in batches:
            rows = (entry for folder in batch.column(0).to_pylist() for entry in _entries(store, base, folder))
            yield from _in_batches((row for row in rows if not _is_bookkeeping(row[0])), schema)

    rounds, frontier, n_folders = [], spark.createDataFrame([("",)], "key string"), 1
    while n_folders:
        path = scratch_folder(spark, "listing")
        tasks = min(n_folders, _TASKS)
        frontier.repartition(tasks).mapInArrow(below, _ENTRY).write.parquet(path)
        found = spark.read.schema(_ENTRY).parquet(path)
        rounds.append(found.where("not folder").select("key", "size", "modified"))
        frontier = found.where("folder").select("key")
        n_folders = frontier.count()
    files = reduce(DataFrame.unionByName, rounds)
    unknown = files.where("size is null").count()
    if not unknown:
        return files
    known = pa.schema([f for f in schema if f.name != "folder"])

    def looked_at(batches):
        store, base = opened(root)
        for batch in batches:
            infos = store.get_file_info([posixpath.join(base, key) for key in batch.column(0).to_pylist()])
            rows = ((key, info.size, info.mtime) for key, info in zip(batch.column(0).to_pylist(), infos) if info.is_file)
            yield from _in_batches(rows, known)

    names = files.select("key").repartition(min(-(-unknown // _LOOKED_AT), _TASKS))
    return names.mapInArrow(looked_at, _LISTED)


def file_inventory(
    spark: SparkSession, path: str, start_after: str | None = None, prefix: str | None = None
) -> DataFrame:
    """``path, key, size, modified, readable`` of every file; ``key`` is relative to ``path``.

    Empty files and names that begin with a dot or an underscore are listed as well.  ``start_after`` keeps the
    keys that sort after it, ``prefix`` those that start with it.  Folders are listed in tasks, round by round;
    stores that only Hadoop knows are listed by the driver.
    """
    files = Files(spark, path)
    root = re.sub(r"^file:/(?!/)", "file:///", files.qualified(path).rstrip("/"))
    if not files.exists(path):
        raise SourceError(f"path {path!r} does not exist")
    try:
        opened(root)
        listed = listed_in_rounds(spark, root)
    except (OSError, pa.ArrowInvalid, pa.ArrowNotImplementedError):
        zone = datetime.timezone.utc
        rows = [(key, size, datetime.datetime.fromtimestamp(at / 1000, zone)) for key, size, at in files.walk_with_times(path) if not _is_bookkeeping(key)]
        listed = spark.createDataFrame(rows, _LISTED)
    inventory = listed.select(F.concat(F.lit(root + "/"), "key").alias("path"), "key", "size", "modified")
    inventory = inventory.withColumn("readable", is_readable_path(F.col("key")))
    if start_after is not None:
        inventory = inventory.where(F.col("key") > start_after)
    if prefix is not None:
        inventory = inventory.where(F.col("key").startswith(prefix))
    return inventory
