"""A directory as a stream that ends when everything has been read."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from millrace.options import ReadOptions
from millrace.sources.policy import apply_policy, source_name
from millrace.sources.readers import parsed_lines


def read_stream(
    spark: SparkSession,
    options: ReadOptions,
    schema: Any = None,
    *,
    with_source: bool | str = False,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    every_name: str | None = None,
) -> DataFrame:
    """The records of ``read`` as a stream; the limits bound one micro-batch.

    With ``size`` the stream belongs to a sibling session with that split size: its queries are in the
    ``streams`` of the frame's own session, and a micro-batch has as many tasks as the size asks for, up to
    ``session.TASKS_PER_CORE`` for each core; beyond that a task reads several pieces of that size.

    The checkpoint of the query remembers the files, so a restart goes on where it stopped.  Spark's own
    stream does not see names with an underscore, and decodes by name.  ``every_name`` is a folder for the
    log of a second stream in the same query, which reads those files, whenever they come, once each; it
    belongs to the query like its checkpoint.  The limits do not hold for them.  Without it, such files are
    refused when the stream starts.
    """
    limits: dict[str, Any] = {}
    if files_per_batch:
        limits["maxFilesPerTrigger"] = files_per_batch
    if bytes_per_batch:
        limits["maxBytesPerTrigger"] = bytes_per_batch
    source = source_name(with_source)
    parsed = parsed_lines(
        spark, options, schema, streaming=True, limits=limits, source=source is not None, exact_text=False, log=every_name
    )
    return apply_policy(parsed, options.on_reject, str(options.path), source)
