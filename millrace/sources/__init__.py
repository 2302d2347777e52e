from millrace.sources.check import SourceError, check_source
from millrace.sources.inventory import file_inventory
from millrace.sources.lines import read_lines, with_source
from millrace.sources.readers import (
    infer_schema,
    read,
    read_csv,
    read_json,
    read_ldjson,
    read_raw,
    read_tsv,
)

__all__ = [
    "SourceError",
    "check_source",
    "file_inventory",
    "infer_schema",
    "read",
    "read_csv",
    "read_json",
    "read_ldjson",
    "read_lines",
    "read_raw",
    "read_tsv",
    "with_source",
]
