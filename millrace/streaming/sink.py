"""Each micro-batch of a stream to its own files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.export import send
from millrace.options import OptionError, WriteOptions


def export_stream(
    df: DataFrame,
    options: WriteOptions,
    checkpoint: str,
    *,
    once: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start writing ``df``; with ``once`` the query stops when the source is read.

    The batch number is part of the file names, and a batch that runs again replaces the
    files of its first try, so a restart neither loses nor repeats records.
    """
    if not options.file_per_slice:
        raise OptionError("a stream writes new files for each batch: file_per_slice must be true")

    def write(batch: DataFrame, number: int) -> None:
        send(batch, options, batch=number)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()
