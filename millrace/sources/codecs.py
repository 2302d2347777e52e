"""Whole-file decoding for bytes that Spark's own scans cannot open.

``binaryFile`` brings a compressed file to a task; the functions here run inside
that task and hand back Arrow batches of lines, a few megabytes at a time.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

STEP = 8 * 1024 * 1024


def _frames(data: pa.Buffer) -> Iterator[bytes]:
    """Decoded bytes of one or more lz4 frames that follow each other."""
    with pa.CompressedInputStream(pa.BufferReader(data), "lz4") as stream:
        while chunk := stream.read(STEP):
            yield chunk


def _members(data: pa.Buffer) -> Iterator[bytes]:
    with gzip.GzipFile(fileobj=pa.BufferReader(data)) as stream:
        while chunk := stream.read(STEP):
            yield chunk


def decoded(data: pa.Buffer, codec: str) -> Iterator[bytes]:
    return _frames(data) if codec == "lz4" else _members(data)


def _as_text(parts: pa.Array) -> pa.Array:
    try:
        return parts.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([item.decode("utf-8", "replace") for item in parts.to_pylist()], pa.string())


def _pieces(block: bytes, delimiter: bytes) -> pa.Array:
    return pc.split_pattern(pa.array([block], pa.large_binary()), pattern=delimiter).values


def line_arrays(chunks: Iterator[bytes], delimiter: bytes) -> Iterator[pa.Array]:
    """Lines without their delimiter; one final delimiter does not start another line."""
    rest = bytearray()
    for chunk in chunks:
        # the delimiter may lie across two chunks
        seen = max(0, len(rest) - len(delimiter) + 1)
        rest += chunk
        if rest.find(delimiter, seen) < 0:
            continue
        pieces = _pieces(bytes(rest), delimiter)
        rest = bytearray(pieces[-1].as_py())
        yield _as_text(pieces.slice(0, len(pieces) - 1))
    if rest:
        yield _as_text(pa.array([bytes(rest)], pa.large_binary()))


def document_array(chunks: Iterator[bytes]) -> pa.Array:
    return _as_text(pa.array([b"".join(chunks)], pa.binary()))
