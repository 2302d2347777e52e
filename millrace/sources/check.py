"""A look at the source before the job starts: names and sizes only."""

from __future__ import annotations

import posixpath
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import SparkSession

from millrace.options import ReadOptions
from millrace.session import Files
from millrace.sources.files import listed, opened
from millrace.sources.names import is_streamed

class SourceError(ValueError):
    """The path cannot be read as a source."""


def streamed_roots(spark: SparkSession, options: ReadOptions) -> list[str]:
    """The paths that hold files which Spark's scans leave out or would open the wrong way (see names.py).

    Folders are listed side by side, names are not kept.  On a store that only Hadoop knows such files cannot
    be streamed, and are refused by name.  ``check_names=False`` leaves the listing out, and with it the files.
    """
    if not options.check_names:
        return []
    roots, whole = [], options.format == "json"
    for path in [options.path] if isinstance(options.path, str) else options.path:
        files = Files(spark, path)
        root = files.qualified(path)
        try:
            opened(root)
            found = any(is_streamed(f.name, f.size, options.compression, whole) for f in listed(root))
        except (OSError, pa.ArrowInvalid, pa.ArrowNotImplementedError):
            if files.exists(path):
                names = files.walk(path) if files.is_directory(path) else [(posixpath.basename(path), files.length(path))]
                _refuse(path, [name for name, size in names if is_streamed(name, size, options.compression, whole) and not _large_only(name, options)])
            continue
        if found:
            roots.append(root)
    return roots


def _large_only(name: str, options: ReadOptions) -> bool:
    return not is_streamed(name, 0, options.compression)


def _refuse(path: str, unread: list[str]) -> None:
    if unread:
        shown = ", ".join(sorted(unread)[:20]) + (", ..." if len(unread) > 20 else "")
        raise SourceError(f"{len(unread)} files below {path!r} would not be read as they are, because of their names: {shown}")


def refuse_streamed(spark: SparkSession, options: ReadOptions) -> None:
    """For a scan of Spark's alone: fail with the names of the files that it would not open as they are."""
    for root in streamed_roots(spark, options):
        _refuse(root, [f.name for f in listed(root) if is_streamed(f.name, f.size, options.compression)])


def stream_roots(spark: SparkSession, options: ReadOptions, log: str | None) -> list[str]:
    """The path of a stream that has a log for the files which Spark's stream leaves out; without, they are refused."""
    if log is None:
        refuse_streamed(spark, options)
        return []
    root = Files(spark, str(options.path)).qualified(str(options.path))
    opened(root)
    return [root]


def check_source(spark: SparkSession, path: str) -> None:
    """Refuse a path that is missing, no directory, empty, or (local) a symbolic link."""
    files = Files(spark, path)
    if not files.exists(path):
        raise SourceError(f"path {path!r} does not exist")
    if urlparse(files.qualified(path)).scheme == "file" and files.is_symlink(path.rstrip("/")):
        raise SourceError(f"path {path!r} must not be a symbolic link")
    if not files.is_directory(path):
        raise SourceError(f"path {path!r} is not a directory")
    if not files.names(path):
        raise SourceError(f"path {path!r} is empty")
