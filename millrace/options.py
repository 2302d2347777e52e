"""Checked settings for readers and writers.

Both classes are plain dataclasses.  ``from_config`` takes the keys of a job
description (a ``dict`` read from JSON, for example) and applies its defaults.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields as dataclass_fields
from typing import Any

# The formats, codecs and bad-record actions that are supported.
FORMATS = ("json", "ldjson", "raw", "tsv", "csv")
COMPRESSIONS = ("none", "lz4", "gzip")
REJECT_ACTIONS = ("throw", "log", "none")

DEFAULT_LINE_DELIMITER = "\n"

# Keys of a job description that belong to the job and not to reader or writer.
JOB_KEYS = frozenset(
    {"_op", "_name", "_type", "_encoding", "_key", "_dead_letter_action", "api_name", "_api_name", "connection", "_connection"}
)


class OptionError(ValueError):
    """A setting is missing, has the wrong type, or contradicts another one."""


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise OptionError(message)


def _choice(name: str, value: Any, allowed: Sequence[str]) -> None:
    _need(value in allowed, f"{name} must be one of {', '.join(allowed)}, got {value!r}")


def _text(name: str, value: Any, optional: bool = True) -> None:
    _need(
        (optional and value is None) or isinstance(value, str),
        f"{name} must be a string, got {type(value).__name__}",
    )


def _flag(name: str, value: Any) -> None:
    _need(isinstance(value, bool), f"{name} must be a boolean, got {type(value).__name__}")


def _names(value: Any) -> tuple[str, ...]:
    _need(
        value is None or (isinstance(value, (list, tuple)) and all(isinstance(f, str) for f in value)),
        "fields must be a list of strings",
    )
    return tuple(value or ())


def _whole_file_rule(compression: str, file_per_slice: bool | None) -> bool:
    """A compressed stream cannot be cut, so it has to be handled file by file."""
    if compression != "none":
        _need(
            file_per_slice is not False,
            "file_per_slice must be true with a compression: a compressed file cannot be divided",
        )
        return True
    return bool(file_per_slice)


def _pick(cls: type, config: Mapping[str, Any], renames: Mapping[str, str]) -> dict[str, Any]:
    """The settings of ``cls``; a job description may serve a reader and a writer, other keys are refused."""
    known = {f.name for f in dataclass_fields(cls)}
    other = {f.name for one in (ReadOptions, WriteOptions) for f in dataclass_fields(one)} | JOB_KEYS | {"on_reject_action"}
    picked: dict[str, Any] = {}
    for key, value in config.items():
        name = renames.get(key, key)
        _need(name in known or key in other, f"unknown setting {key!r}")
        if name in known and value is not None:
            picked[name] = value
    return picked


@dataclass(frozen=True)
class ReadOptions:
    path: str | Sequence[str]
    format: str
    compression: str = "none"
    line_delimiter: str = DEFAULT_LINE_DELIMITER
    field_delimiter: str | None = None
    fields: Sequence[str] = ()
    file_per_slice: bool | None = None
    size: int | None = None
    on_reject: str = "throw"
    remove_header: bool = True
    ignore_empty: bool = True
    extra_args: Mapping[str, Any] = field(default_factory=dict)
    #: reject lines with more or fewer cells than ``fields`` (csv / tsv)
    check_width: bool = False
    #: what a line with values beyond ``fields`` is: "reject" a bad record, "cut" a record without them
    surplus: str = "reject"
    #: list the path first and refuse files that Spark would leave out or decode by their name
    check_names: bool = True
    #: True checks every record in full; False is for trusted input: json and ldjson use Spark's
    #: own scan, csv and tsv skip the checks for open quotes and unusual blanks
    strict: bool = True

    def __post_init__(self) -> None:
        path_ok = isinstance(self.path, str) or (
            isinstance(self.path, (list, tuple))
            and len(self.path) > 0
            and all(isinstance(p, str) for p in self.path)
        )
        _need(path_ok and self.path != "", "path must be a non-empty string (or a list of them)")
        _choice("format", self.format, FORMATS)
        _choice("compression", self.compression, COMPRESSIONS)
        _choice("on_reject", self.on_reject, REJECT_ACTIONS)
        _choice("surplus", self.surplus, ("reject", "cut"))
        _text("line_delimiter", self.line_delimiter, optional=False)
        _need(self.line_delimiter != "", "line_delimiter must not be empty")
        _text("field_delimiter", self.field_delimiter)
        object.__setattr__(self, "fields", _names(self.fields))
        for name in ("remove_header", "ignore_empty", "check_width", "check_names", "strict"):
            _flag(name, getattr(self, name))
        if self.file_per_slice is not None:
            _flag("file_per_slice", self.file_per_slice)
        object.__setattr__(
            self, "file_per_slice", _whole_file_rule(self.compression, self.file_per_slice)
        )
        _need(isinstance(self.extra_args, Mapping), "extra_args must be a mapping")
        _need(
            self.size is None
            or (isinstance(self.size, int) and not isinstance(self.size, bool) and self.size > 0),
            "size must be a positive number of bytes",
        )
        if self.format in ("csv", "tsv"):
            _need(len(self.fields) > 0, f"fields are required for {self.format}")
            _need(len(set(self.fields)) == len(self.fields), "fields must not repeat a name")
        if self.format == "tsv":
            _need(
                self.field_delimiter in (None, "\t"),
                "field_delimiter must be a tab for tsv; use csv for another delimiter",
            )

    @property
    def separator(self) -> str:
        return self.field_delimiter or ("\t" if self.format == "tsv" else ",")

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> "ReadOptions":
        """Settings of a read job.  Without ``size`` Spark chooses the grain of the scan."""
        _need("path" in config, "path is required")
        _need("format" in config, "format is required")
        picked = _pick(
            cls,
            config,
            {"on_reject_action": "on_reject", "_dead_letter_action": "on_reject"},
        )
        picked.setdefault("file_per_slice", False)
        return cls(**picked)


@dataclass(frozen=True)
class WriteOptions:
    path: str
    format: str
    id: str = "part"
    compression: str = "none"
    line_delimiter: str = DEFAULT_LINE_DELIMITER
    field_delimiter: str | None = None
    fields: Sequence[str] = ()
    file_per_slice: bool = True
    include_header: bool = False
    extension: str | None = None
    keep_nulls: bool = False
    #: True writes floats in json as the shortest text that reads back (``42``, ``1e+21``), False as Spark does
    #: (``42.0``, ``1.0E21``), which is the same number and takes a third of the time
    plain_numbers: bool = False
    #: "keep" writes a line delimiter inside a csv cell as it is, "throw" refuses it
    line_breaks: str = "keep"
    dynamic_routing: bool = False
    #: column that carries the route; it is never part of the written record
    route_col: str | None = None
    #: "plain" writes path/<route>/, "hive" writes path/<route_col>=<route>/
    layout: str | None = None
    #: True brings the rows of a route together first (a shuffle, few files); False writes each
    #: task's share of each route as it is (no shuffle; right when there are few routes)
    gather_routes: bool = True
    #: "exact" renames the files to <id>[.<n>].<ext> at commit; in "direct" tasks write them under such names,
    #: with gaps in the numbers (on a store that only Hadoop can open, Spark's own names are kept)
    naming: str | None = None
    #: number of output files wanted; None keeps the partitions as they are
    files: int | None = None
    records_per_file: int | None = None
    #: bound of one json array or lz4 frame, measured before compression
    bytes_per_file: int = 64 * 1024 * 1024
    #: files that are moved to their names at the same time
    concurrency: int = 10
    #: whose files these are: another run of the job (a new application, or a new ``Sender``) replaces what
    #: the last one wrote.  None is the job that has the name of the id
    job: str | None = None
    #: first number used in the file names: files with the same numbers are replaced, others stay.
    #: None goes on after the highest number that stays in the folder
    first_slice: int | None = None
    #: True removes what earlier exports of the id left below the path, in all routes, once the
    #: new files are there; numbers start from 0 again
    replace: bool = False

    def __post_init__(self) -> None:
        _text("path", self.path, optional=False)
        _need(self.path != "", "path must not be empty")
        _choice("format", self.format, FORMATS)
        _choice("compression", self.compression, COMPRESSIONS)
        _text("id", self.id, optional=False)
        _need(self.id != "" and "/" not in self.id, "id must be a non-empty name without '/'")
        _text("line_delimiter", self.line_delimiter, optional=False)
        _need(self.line_delimiter != "", "line_delimiter must not be empty")
        _text("field_delimiter", self.field_delimiter)
        _text("extension", self.extension)
        _text("route_col", self.route_col)
        _text("job", self.job)
        object.__setattr__(self, "fields", _names(self.fields))
        for name in (
            "file_per_slice",
            "include_header",
            "keep_nulls",
            "plain_numbers",
            "dynamic_routing",
            "gather_routes",
            "replace",
        ):
            _flag(name, getattr(self, name))
        _need(not (self.replace and self.first_slice is not None), "replace removes all numbers: leave first_slice out")
        _whole_file_rule(self.compression, self.file_per_slice)
        if self.format == "json":
            _need(self.file_per_slice, "file_per_slice must be true for json: a file is one array")
        _choice("line_breaks", self.line_breaks, ("keep", "throw"))
        if self.layout is not None:
            _choice("layout", self.layout, ("plain", "hive"))
        if self.naming is not None:
            _choice("naming", self.naming, ("exact", "direct"))
        _need(
            self.first_slice is None
            or (isinstance(self.first_slice, int) and not isinstance(self.first_slice, bool) and self.first_slice >= 0),
            "first_slice must be a number from 0 on",
        )
        for name in ("files", "records_per_file"):
            value = getattr(self, name)
            _need(
                value is None or (isinstance(value, int) and not isinstance(value, bool) and value > 0),
                f"{name} must be a positive number",
            )
        _need(self.bytes_per_file > 0, "bytes_per_file must be a positive number")
        _need(
            isinstance(self.concurrency, (int, float))
            and not isinstance(self.concurrency, bool)
            and self.concurrency > 0,
            "concurrency must be a number greater than 0",
        )
        if self.dynamic_routing:
            _need(self.route_col is not None, "routing needs route_col, the column with the route")
        if self.store_of_objects:
            _need(
                self.file_per_slice,
                "file_per_slice must be true on an object store: objects cannot be appended to",
            )
    # Schemes where a rename copies the data.
    OBJECT_SCHEMES = ("s3", "s3a", "s3n", "gs", "oss", "cosn", "obs")

    @property
    def store_of_objects(self) -> bool:
        scheme, mark, _ = self.path.partition("://")
        return bool(mark) and scheme.lower() in self.OBJECT_SCHEMES

    @property
    def job_name(self) -> str:
        return self.id if self.job is None else self.job

    @property
    def naming_mode(self) -> str:
        return self.naming or ("direct" if self.store_of_objects else "exact")

    @property
    def layout_mode(self) -> str:
        return self.layout or ("plain" if self.naming_mode == "exact" else "hive")

    @property
    def separator(self) -> str:
        return self.field_delimiter or ("\t" if self.format == "tsv" else ",")

    @classmethod
    def from_config(cls, config: Mapping[str, Any], *, file_per_slice: bool = False) -> "WriteOptions":
        """Settings of an export job; the old ``_key`` setting turns routing on."""
        _need("path" in config, "path is required")
        _need("format" in config, "format is required")
        picked = _pick(cls, config, {})
        picked.setdefault("file_per_slice", file_per_slice)
        if config.get("_key"):
            picked["dynamic_routing"] = True
        if picked.get("dynamic_routing"):
            picked.setdefault("route_col", "route")
        return cls(**picked)
