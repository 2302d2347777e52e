"""File ingest and export on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from millrace.functions import (
    is_readable_path,
    is_valid_bucket_name,
    object_uri,
    parse_object_path,
    project_fields,
    render_csv,
    render_ldjson,
    render_raw,
    render_tsv,
)
from millrace.operators import (
    Sender,
    counted,
    export,
    export_routed,
    file_exporter,
    file_reader,
    inventory_summary,
    render_json,
    routed_sender,
    s3_exporter,
    s3_reader,
    send,
)
from millrace.options import OptionError, ReadOptions, WriteOptions
from millrace.plans import file_name
from millrace.session import scratch_folder
from millrace.sources import (
    SourceError,
    check_source,
    file_inventory,
    read,
    read_csv,
    read_json,
    read_ldjson,
    read_raw,
    read_tsv,
    with_source,
)
from millrace.streaming import export_stream, read_stream

# The Arrow helpers travel to the executors with the job, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    name for name in dir() if not name.startswith("_") and name not in ("sys", "cloudpickle")
]
