from millrace.functions.paths import (
    is_readable_path,
    is_valid_bucket_name,
    object_uri,
    parse_object_path,
)
from millrace.functions.project import project_fields
from millrace.functions.render import (
    csv_cell,
    header_line,
    render_csv,
    render_ldjson,
    render_raw,
    render_tsv,
)
from millrace.functions.text import plain_number, trim_cell

__all__ = [
    "csv_cell",
    "header_line",
    "is_readable_path",
    "is_valid_bucket_name",
    "object_uri",
    "parse_object_path",
    "plain_number",
    "project_fields",
    "render_csv",
    "render_ldjson",
    "render_raw",
    "render_tsv",
    "trim_cell",
]
