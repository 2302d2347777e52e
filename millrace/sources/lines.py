"""Files to a frame of lines: one column ``value``, and ``source`` when it is asked for.

Uncompressed files and ``.gz`` files go through Spark's splitting text scan.  Bytes that it
cannot decode (lz4 frames, gzip without its extension) are read whole and decoded in Arrow
tasks; what is too large for that, and names that Spark's scans do not take as they are, go
through the source of ``files.py``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import adopt, sized_session
from millrace.sources.codecs import decoded, document_array, line_arrays
from millrace.sources.files import streamed_lines
from millrace.sources.names import LARGE, split_pattern

SOURCE_TYPE = "struct<path:string,offset:bigint,length:bigint,total:bigint>"

# The columns of Spark's binaryFile format.
_FILE_TYPE = "path string, modificationTime timestamp, length bigint, content binary"

_GZ_NAMES = "*.gz"
# every name that does not end in ".gz"
_OTHER_NAMES = "{*[^z],*[^g]z,*[^.]gz,z,gz}"


def file_path() -> Column:
    """The path of a scanned file as it is called; the scan tells it in the spelling of an address."""
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:///")


def source_struct() -> Column:
    """Where a row of a file scan comes from: file, split offset and length, file size."""
    return F.struct(
        file_path().alias("path"),
        F.col("_metadata.file_block_start").alias("offset"),
        F.col("_metadata.file_block_length").alias("length"),
        F.col("_metadata.file_size").alias("total"),
    )


def with_source(df: DataFrame, name: str = "source") -> DataFrame:
    """Add the provenance struct to a frame that comes straight from a file scan."""
    return df.select("*", source_struct().alias(name))


def _reader(spark: SparkSession, streaming: bool, limits: dict):
    reader = spark.readStream if streaming else spark.read
    return reader.options(recursiveFileLookup=True, **limits)


def _text_lines(reader, path, delimiter: str, whole: bool, source: bool, but: str | None = None) -> DataFrame:
    reader = reader.option("wholetext", True) if whole else reader.option("lineSep", delimiter)
    origin = source_struct() if source else F.lit(None).cast(SOURCE_TYPE)
    lines = reader.format("text").load(path)
    if but is not None:
        # files that match are left out of the listing, not opened
        lines = lines.where(~F.col("_metadata.file_name").rlike(but))
    return lines.select("value", origin.alias("source"))


def _decoded_lines(reader, path, codec: str, delimiter: str, whole: bool, source: bool, small: bool = False) -> DataFrame:
    mark = delimiter.encode("utf-8")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = batch.column("content")
            for row in range(batch.num_rows):
                chunks = decoded(contents[row].as_buffer(), codec)
                for lines in [document_array(chunks)] if whole else line_arrays(chunks, mark):
                    if source:
                        place = pa.array([row] * len(lines), pa.int64())
                        columns = [lines, batch.column("source").take(place)]
                    else:
                        columns = [lines]
                    yield pa.RecordBatch.from_arrays(columns, names=["value", "source"][: len(columns)])

    files = reader.format("binaryFile").schema(_FILE_TYPE).load(path)
    if small:
        files = files.where(F.col("length") <= LARGE)
    if not source:
        lines = files.select("content").mapInArrow(rows, "value string")
        return lines.select("value", F.lit(None).cast(SOURCE_TYPE).alias("source"))
    origin = F.struct(
        file_path().alias("path"),
        F.lit(0).cast("bigint").alias("offset"),
        F.col("length"),
        F.col("length").alias("total"),
    )
    return files.select("content", origin.alias("source")).mapInArrow(
        rows, f"value string, source {SOURCE_TYPE}"
    )


def read_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    compression: str = "none",
    line_delimiter: str = "\n",
    size: int | None = None,
    whole: bool = False,
    source: bool = True,
    streaming: bool = False,
    limits: dict | None = None,
    streamed: Sequence[str] = (),
    log: str | None = None,
) -> DataFrame:
    """``value``, ``source`` for every line (or, with ``whole``, every file) below ``path``.

    Without ``source`` that column is null, and the scan need not produce it.  ``streamed`` are the paths
    that hold files for the source of ``files.py``; a stream of these keeps its ``log`` in a folder.
    """
    session = spark if size is None else sized_session(spark, size)
    limits = dict(limits or {})

    def reader(**more):
        return _reader(session, streaming, {**limits, **more})

    if streaming and not isinstance(path, str):
        raise ValueError("a stream reads one path")
    path = path if isinstance(path, str) else list(path)
    layout = (line_delimiter, whole, source)
    apart = bool(streamed)
    if compression == "none":
        lines = _text_lines(reader(), path, *layout, split_pattern(compression) if apart else None)
    elif compression == "gzip":
        native = _text_lines(reader(pathGlobFilter=_GZ_NAMES), path, *layout)
        other = _decoded_lines(reader(pathGlobFilter=_OTHER_NAMES), path, "gzip", *layout, apart and not whole)
        lines = native.union(other)
    else:
        lines = _decoded_lines(reader(), path, compression, *layout, apart and not whole)
    lines = lines if session is spark else adopt(spark, lines)
    if apart:
        more = streamed_lines(spark, streamed, compression=compression, delimiter=line_delimiter, whole=whole, size=size, log=log)
        lines = lines.union(more if source else more.select("value", F.lit(None).cast(SOURCE_TYPE).alias("source")))
    return lines
