"""Names of output files: ``<path>/<id>[.<number>].<format>[.gz|.lz4]``."""

from __future__ import annotations

import posixpath
from typing import Any

# What each codec adds to a name.
CODEC_SUFFIX = {"none": "", "lz4": ".lz4", "gzip": ".gz"}


def suffix(format: str, compression: str = "none", extension: str | None = None) -> str:
    """The part after id and number; ``extension`` replaces it and gets its dot if it lacks one."""
    if extension is not None:
        return extension if extension == "" or extension.startswith(".") else "." + extension
    # `raw` names a way to read, not a kind of content
    return ("" if format == "raw" else "." + format) + CODEC_SUFFIX[compression]


def file_name(
    path: str,
    id: str,
    *,
    format: str,
    compression: str = "none",
    file_per_slice: bool = False,
    slice_count: Any = None,
    extension: str | None = None,
) -> str:
    """The name of an output file; the settings come from checked ``WriteOptions``."""
    number = f".{slice_count}" if file_per_slice else ""
    return posixpath.join(path, id) + number + suffix(format, compression, extension)
