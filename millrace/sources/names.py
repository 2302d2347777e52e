"""Which files below a path are data, and which of them Spark's own scans open as they should."""

from __future__ import annotations

import posixpath

# What Spark's own writers leave beside data.
MARKS = ("_SUCCESS", "_temporary", "_spark_metadata", "_metadata", "_common_metadata")
# Endings that make Spark's text scan decode a file.
CODEC_ENDINGS = (".gz", ".bz2", ".lz4", ".snappy", ".deflate", ".zst")
# Files that a task should not hold as a whole, in bytes.
LARGE = 128 * 1024 * 1024


def is_data(name: str) -> bool:
    """No part of the name below the path starts with a dot, and none is a mark of a writer."""
    return not any(part.startswith(".") or part in MARKS for part in name.split("/"))


def is_hidden(name: str) -> bool:
    """Whether Spark's listing leaves the file out although it is data."""
    parts = name.split("/")
    underscored = any(p.startswith("_") and "=" not in p and not p.startswith(("_metadata", "_common_metadata")) for p in parts)
    return is_data(name) and (underscored or any(p.endswith("._COPYING_") for p in parts))


def is_streamed(name: str, size: int, compression: str, whole: bool = False, large: int | None = None) -> bool:
    """Whether the file goes through the source of ``files.py``: hidden files, files that Spark would decode by
    a name that says nothing about their bytes, and large ones that only a whole-file read could decode.
    """
    if not is_data(name):
        return False
    base = posixpath.basename(name)
    if is_hidden(name):
        return True
    if compression == "none":
        return base.endswith(CODEC_ENDINGS)
    native = compression == "gzip" and base.endswith(".gz")
    return not native and size > (LARGE if large is None else large) and not whole


def split_pattern(compression: str) -> str | None:
    """What the names of files match that the other scans must leave to the source, beside hidden and large ones."""
    return r"\.(" + "|".join(e[1:] for e in CODEC_ENDINGS) + r")\z" if compression == "none" else None
