"""Lines to file bodies, for outputs that are more than lines one after the other.

Some outputs need to know where a file begins or ends: a json array and an lz4
frame.  They are built in Arrow tasks that see the lines of a partition in order, so no
shuffle is needed; each body becomes one row and the writer puts one row in one file.
A body is closed at ``records_per_file`` or ``bytes_per_file``, whichever comes first.
A routed csv with a header is the third kind: its header has to be the first line of each
file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the end mark of an lz4 frame.  The text writer adds it as its line separator.
LZ4_END_MARK = "\0\0\0\0"


def with_header(header: str, line_delimiter: str, records_per_file: int | None) -> Column:
    """``value`` with the header before the first line of each file, still inside the JVM.

    The low 33 bits of ``monotonically_increasing_id`` count the rows of a partition.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    first = row % records_per_file == 0 if records_per_file else row == 0
    return F.when(first, F.concat(F.lit(header + line_delimiter), F.col("value"))).otherwise(
        F.col("value")
    )


def _runs(routes: pa.Array | None, rows: int) -> list[tuple[int, int]]:
    """Start and end of each stretch of rows with the same route."""
    if rows == 0:
        return []
    if routes is None or rows == 1:
        return [(0, rows)]
    same = pc.fill_null(pc.equal(routes[1:], routes[:-1]), False)
    both_null = pc.and_(pc.is_null(routes[1:]), pc.is_null(routes[:-1]))
    changes = pc.indices_nonzero(pc.invert(pc.or_(same, both_null))).to_pylist()
    edges = [0, *[int(c) + 1 for c in changes], rows]
    return list(zip(edges, edges[1:]))


class _Body:
    """One json array or one lz4 frame while it grows."""

    def __init__(self, array: bool, lz4: bool, delimiter: bytes, header: bytes | None):
        self.array, self.delimiter = array, delimiter
        self.records = 0
        self.size = 0
        self._sink = pa.BufferOutputStream()
        self._out = pa.CompressedOutputStream(self._sink, "lz4") if lz4 else self._sink
        if header is not None and not array:
            self._write(header + delimiter)

    def _write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def add(self, values: pa.Array) -> None:
        between = b"," if self.array else self.delimiter
        if self.records == 0:
            lead = b"[" if self.array else b""
        else:
            lead = b"," if self.array else b""
        joined = pc.binary_join(
            pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(pa.binary())),
            between,
        )[0].as_buffer()
        if lead:
            self._write(lead)
        self._write(joined)
        if not self.array:
            self._write(self.delimiter)
        self.records += len(values)

    def close(self, lz4: bool) -> bytes:
        if self.array:
            # the writer adds the final delimiter of an uncompressed array
            self._write(b"]" + (self.delimiter if lz4 else b""))
        if not lz4:
            # the writer adds the last delimiter of a body of lines
            body = self._sink.getvalue().to_pybytes()
            return body if self.array else body[: -len(self.delimiter)]
        self._out.close()
        frame = self._sink.getvalue().to_pybytes()
        mark = LZ4_END_MARK.encode()
        if not frame.endswith(mark):
            raise ValueError("the lz4 encoder wrote a frame without a plain end mark")
        return frame[: -len(mark)]


# Lines are handed to a body in steps of about this many bytes, so its bound is kept closely.
_STEP_BYTES = 1024 * 1024


def pack_files(
    lines: DataFrame,
    *,
    array: bool,
    lz4: bool,
    line_delimiter: str,
    header: str | None = None,
    route: str | None = None,
    records_per_file: int | None = None,
    bytes_per_file: int = 64 * 1024 * 1024,
) -> DataFrame:
    """One row per output file; with ``route`` the input is sorted by it inside partitions."""
    delimiter = line_delimiter.encode("utf-8")
    head = None if header is None else header.encode("utf-8")
    limit = records_per_file or (1 << 62)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body: _Body | None = None
        current = None

        def closed() -> pa.RecordBatch:
            columns = [pa.array([body.close(lz4)], pa.binary())]
            names = ["value"]
            if route:
                columns.append(pa.array([current], pa.string()))
                names.append(route)
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            values = batch.column(0)
            routes = batch.column(1) if route else None
            mean = max(1, values.nbytes // max(1, len(values)))
            step = max(1, _STEP_BYTES // mean)
            for start, end in _runs(routes, batch.num_rows):
                name = routes[start].as_py() if route else None
                if body is not None and name != current:
                    yield closed()
                    body = None
                current = name
                while start < end:
                    if body is None:
                        body = _Body(array, lz4, delimiter, head)
                    take = min(end - start, step, limit - body.records)
                    body.add(values.slice(start, take))
                    start += take
                    if body.records >= limit or body.size >= bytes_per_file:
                        yield closed()
                        body = None
        if body is not None:
            yield closed()

    kept = lines.select("value", *([route] if route else []))
    packed = kept.mapInArrow(rows, "value binary" + (f", `{route}` string" if route else ""))
    # the text writer copies the bytes of a string as they are
    return packed.withColumn("value", F.col("value").cast("string"))
