"""The commit step: staged part files become named files.

Spark writes into a hidden folder below the target, with its own commit protocol, so
failed and repeated tasks leave nothing behind.  The driver then moves the finished
files; it handles names and lengths only, never data.
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
from collections import defaultdict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from urllib.parse import unquote

from pyspark.sql import SparkSession

from millrace.options import WriteOptions
from millrace.plans.direct import FURTHER, remove_listed, remove_unlisted
from millrace.plans.naming import file_name, suffix
from millrace.plans.slices import Slice, SliceLog, superseded
from millrace.session import Files
from millrace.sources.inventory import names_below

# Fixed value: the folder name Spark gives to a partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Fixed value: length of a gzip member that holds nothing.
EMPTY_GZIP_BYTES = 20

def staging_folder(options: WriteOptions) -> str:
    return posixpath.join(options.path, f".{options.id}-{uuid.uuid4().hex[:12]}")


def _is_empty(length: int, compression: str) -> bool:
    return length <= (EMPTY_GZIP_BYTES if compression == "gzip" else 0)


def route_folder(part: str, route_col: str | None, layout: str) -> str:
    """Folder of a staged file below the target; a record without a route stays at the root."""
    folder = posixpath.dirname(part)
    if not folder or route_col is None:
        return ""
    if layout == "hive":
        return folder
    value = folder.partition("=")[2]
    if value == NO_VALUE:
        return ""
    value = unquote(value)
    if ".." in value.split("/"):
        raise ValueError(f"route {value!r} leaves the target folder")
    folder = posixpath.normpath(value).strip("/") if value.strip("/") else ""
    return "" if folder == "." else folder


def _numbered(files: Files, folder: str, options: WriteOptions, number: str) -> dict[int, str]:
    """The files of this id in ``folder`` by their number; ``number`` is how it is written."""
    tail = suffix(options.format, options.compression, options.extension)
    pattern = re.compile(re.escape(options.id) + number + re.escape(tail) + r"\Z")
    found = {}
    if files.exists(folder):
        for name, _ in files.names(folder):
            match = pattern.match(name)
            if match:
                found[int(match.group(1) or 0)] = posixpath.join(folder, name)
    return found


def _next_free(files: Files, folder: str, options: WriteOptions) -> int:
    """Appended files are ``<id><ext>``, ``<id>-1<ext>``, ...: the first unused number."""
    return max([-1, *_numbered(files, folder, options, r"(?:-(\d+))?")]) + 1


def publish(
    spark: SparkSession, staging: str, options: WriteOptions, batch: int | None = None, run: str = ""
) -> list[str]:
    """Move the staged files to their names and return these; empty parts are dropped.

    ``batch`` is the number of a stream batch: its files carry it, and whatever an earlier
    try of the same batch left behind is replaced.  Other files are noted in the log of slices,
    before they are moved, and take the place of those of an earlier ``run``.
    """
    files = Files(spark, options.path)
    if not files.exists(staging):
        return []
    groups: dict[str, list[str]] = defaultdict(list)
    routed = options.route_col if options.dynamic_routing else None
    for part, length in sorted(files.walk(staging)):
        if posixpath.basename(part).startswith(("_", ".")) or _is_empty(length, options.compression):
            continue
        groups[route_folder(part, routed, options.layout_mode)].append(part)

    placed = [(posixpath.join(options.path, folder), parts) for folder, parts in groups.items()]
    before = earlier_files(files, options) if options.replace and batch is None else []
    log = SliceLog(files, options.path, options.id) if is_logged(options) and batch is None else None
    old = [] if log is None else log.entries() if options.replace else superseded(log.entries(), options.job_name, run, None)
    before += [posixpath.join(options.path, name) for entry in old for name in log.names(entry)]
    with ThreadPoolExecutor(max(1, int(options.concurrency))) as movers:
        if batch is not None:
            targets = {options.path, *[target for target, _ in placed]}
            earlier = movers.map(lambda target: _of_batch(files, target, options, batch), targets)
            list(movers.map(files.remove, [path for found in earlier for path in found]))
        gone = set(before)
        plans = movers.map(lambda item: _names(files, *item, options, batch, gone), placed)
        moves = [
            (posixpath.join(staging, part), name)
            for (_, parts), names in zip(placed, plans)
            for part, name in zip(parts, names)
        ]
        entry = None
        if log is not None and moves:
            named = tuple(name.removeprefix(options.path.rstrip("/") + "/") for _, name in moves)
            entry = log.note(Slice(options.job_name, run, files=named))
        try:
            list(movers.map(lambda move: files.replace(*move), moves))
        except BaseException:
            if entry is not None:
                list(movers.map(files.remove, [name for _, name in moves]))
                log.forget([entry])
            raise
        placed_now = {name for _, name in moves}
        list(movers.map(files.remove, [path for path in before if path not in placed_now]))
        if entry is not None:
            log.note(replace(entry, done=True))
        if log is not None:
            log.forget(old)
    return [name for _, name in moves]


def is_logged(options: WriteOptions) -> bool:
    """Whether an export belongs to a run of a job: not if its numbers are given, or if it appends."""
    return options.file_per_slice and options.first_slice is None


def publish_direct(spark: SparkSession, options: WriteOptions, batch: int | None, run: str, write: Callable[[int, int, str], None]) -> int:
    """``write(offset, low, manifest)`` makes the files of a slice under their names; the number of records.

    What the slice replaces is removed once it is done, in tasks where tasks have listed it: the driver sees the
    numbers of tasks, no names.  The log says before where its numbers begin, so what a
    run that died has left is found by the next one.  Of a stream the entries of the last batches are kept.
    """
    files = Files(spark, options.path)
    files.make_directory(options.path)
    log = SliceLog(files, options.path, options.id)
    entries = log.entries()
    if batch is not None or is_logged(options):
        old = entries if options.replace and batch is None else superseded(entries, options.job_name, run, batch)
    else:
        old = []
    before = earlier_files(files, options) if options.replace and batch is None else []
    before += [posixpath.join(options.path, name) for entry in old for name in entry.files]
    tail = suffix(options.format, options.compression, options.extension)
    root, every = files.qualified(options.path), {name for e in entries for name in e.files}
    taken = {number for e in entries for number in e.numbers}
    for failed in (e for e in entries if e.run == run and e.failed):
        remove_unlisted(root, options.id, tail, range(failed.low, FURTHER), every, taken)
        log.forget([failed])
    mine = [entry for entry in entries if entry.run == run and entry.done]
    if mine:
        offset, low = mine[0].offset, 1 + max(entry.last for entry in mine)
    else:
        there = (_number_of(name, options) for name in names_below(root))
        offset = low = 1 + max((number % FURTHER for number in there if number is not None), default=-1)
    entry = log.note(Slice(options.job_name, run, batch, offset=offset, low=low))
    manifest = log.manifest(entry)
    try:
        write(offset, low, files.qualified(manifest))
    except BaseException:
        remove_unlisted(root, options.id, tail, range(low, FURTHER), set())
        log.note(replace(entry, failed=True))
        raise
    made = json.loads(files.read_text(manifest))
    log.note(replace(entry, done=True, numbers=tuple(made["numbers"]), last=max([low - 1, *made["numbers"]])))
    remove_earlier(spark, options, before)
    remove_listed(spark, root, [files.qualified(place) for e in old for place in log.lists(e)])
    kept = {name for e in entries if e not in old for name in e.files}
    taken = {number for e in entries if e not in old for number in e.numbers}
    for dead in (e for e in old if not e.done and e.low is not None):
        remove_unlisted(root, options.id, tail, range(dead.low, low), kept, taken)
    log.forget(old)
    if batch is not None:
        log.forget([e for e in entries if e.job == options.job_name and e.batch is not None and e.batch < batch - 1])
    files.remove(manifest)
    return made["records"]


def _number_of(name: str, options: WriteOptions) -> int | None:
    """The number in the name of a file of the id."""
    tail = suffix(options.format, options.compression, options.extension)
    match = re.fullmatch(re.escape(options.id) + r"\.(\d+)" + re.escape(tail), posixpath.basename(name))
    return match and int(match[1])


def earlier_files(files: Files, options: WriteOptions) -> list[str]:
    """All files below the target that exports of this id have made, whatever their numbers or routes."""
    if not files.exists(options.path):
        return []
    stem, tail = re.escape(options.id), re.escape(suffix(options.format, options.compression, options.extension))
    numbered = stem + (r"\.\d+" if options.file_per_slice else r"(?:-\d+)?") + tail
    own = stem + r"-\d{5,}-[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}[-.][^/]*"
    name = re.compile(numbered + r"\Z" if options.naming_mode == "exact" else f"(?:{numbered}|{own})" + r"\Z")
    listed = (path for path, _ in files.walk(options.path))
    mine = [path for path in listed if name.match(posixpath.basename(path)) and not path.startswith(".")]
    return [posixpath.join(options.path, path) for path in mine]


def remove_earlier(spark: SparkSession, options: WriteOptions, before: list[str]) -> None:
    files = Files(spark, options.path)
    with ThreadPoolExecutor(max(1, int(options.concurrency))) as movers:
        list(movers.map(files.remove, before))


def _of_batch(files: Files, target: str, options: WriteOptions, batch: int) -> list[str]:
    """What an earlier try of a stream batch left in ``target``."""
    number = re.escape(f".{batch}") + r"\.(\d+)"
    return list(_numbered(files, target, options, number).values())


def _names(
    files: Files, target: str, parts: list[str], options: WriteOptions, batch: int | None, gone: set[str]
) -> list[str]:
    """Final names of the parts of one folder; ``gone`` are files that are about to be replaced."""
    naming = dict(format=options.format, compression=options.compression, extension=options.extension)
    if not options.file_per_slice:
        free = 0 if options.replace else _next_free(files, target, options)
        stems = [options.id if n == 0 else f"{options.id}-{n}" for n in range(free, free + len(parts))]
        names = [file_name(target, stem, **naming) for stem in stems]
    else:
        stem = options.id if batch is None else f"{options.id}.{batch}"
        start = options.first_slice or 0
        if batch is None and options.first_slice is None and not options.replace:
            there = _numbered(files, target, options, r"\.(\d+)")
            start = max([-1, *(number for number, path in there.items() if path not in gone)]) + 1
        names = [
            file_name(target, stem, file_per_slice=True, slice_count=start + index, **naming)
            for index in range(len(parts))
        ]
    files.make_directory(target)
    return names


def drop_empty_first_part(spark: SparkSession, options: WriteOptions, folder: str, but: set[str]) -> None:
    """Direct naming: Spark writes part 0 even when it has no rows."""
    files = Files(spark, folder)
    for path in files.glob(posixpath.join(folder, f"{options.id}-00000-*")):
        if path not in but and _is_empty(files.length(path), options.compression):
            files.remove(path)
