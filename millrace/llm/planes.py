"""Token ids in bit-plane or byte-plane files: write a corpus, read it back.

File layout, all numbers little-endian::

    b"MRPLANE1"
    block*        planes of up to BLOCK_IDS ids, each plane one zstandard frame, lowest plane first
    documents     one zstandard frame: null flags (1 byte each), doc_ids (int64), lengths (int64)
    index         one zstandard frame: int64 rows of (offset, ids, size of each plane ...), a row per block
    footer        int64: planes per block, blocks, documents, ids, size of `documents`, size of `index`
    b"MRPLANE1"

Plane ``k`` of a block holds byte ``k`` (or bit ``k``, eight ids a byte) of every id.  The upper planes of
token ids are nearly constant, so they compress to almost nothing.  A reader needs one block at a time.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices, stored
from millrace.llm.tokens import encoder, vocabulary_path
from millrace.session import scratch_folder

MAGIC = b"MRPLANE1"
BLOCK_IDS = 1 << 16
#: Appended to every document of the token file.
END_ID = 2

MANIFEST = "part int, n_docs long, n_tokens long, n_bytes long"
DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def split_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The 4 byte planes or 32 bit planes of 32-bit ids."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [octets[:, k].tobytes() for k in range(4)]
    single = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(single[:, k], bitorder="little").tobytes() for k in range(32)]


def join_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The inverse of ``split_planes`` for ``n`` ids."""
    columns = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    if len(planes) == 32:
        single = np.stack([np.unpackbits(c, count=n, bitorder="little") for c in columns.T], axis=1)
        columns = np.packbits(single, axis=1, bitorder="little")
    return np.ascontiguousarray(columns).view("<u4").reshape(-1)


class PlaneWriter:
    """Writes documents one after another; holds one block and the table of documents."""

    def __init__(self, out, bits: bool = False, level: int = 3) -> None:
        self.out, self.bits = out, bits
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.held: list[bytes] = []
        self.n_held = self.n_ids = 0
        self.docs: list[tuple[bool, int, int]] = []
        self.index: list[list[int]] = []
        self.at = self.out.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id is None, doc_id or 0, len(ids) // 4))
        self.held.append(ids)
        self.n_held += len(ids) // 4
        if self.n_held >= BLOCK_IDS:
            self._blocks(whole=True)

    def _blocks(self, whole: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        end = len(ids) // BLOCK_IDS * BLOCK_IDS if whole else len(ids)
        for k in range(0, end, BLOCK_IDS):
            block = ids[k : min(k + BLOCK_IDS, end)]
            planes = [self.pack(p) for p in split_planes(block, self.bits)]
            self.index.append([self.at, len(block), *map(len, planes)])
            self.at += sum(map(self.out.write, planes))
            self.n_ids += len(block)
        self.held, self.n_held = [ids[end:].tobytes()], len(ids) - end

    def close(self) -> tuple[int, int, int]:
        """Documents, ids and bytes of the file."""
        self._blocks(whole=False)
        null, keys, lengths = (list(x) for x in zip(*self.docs)) if self.docs else ([], [], [])
        table = self.pack(bytes(null) + np.array(keys, "<i8").tobytes() + np.array(lengths, "<i8").tobytes())
        index = self.pack(np.array(self.index, "<i8").tobytes())
        footer = [32 if self.bits else 4, len(self.index), len(self.docs), self.n_ids, len(table), len(index)]
        self.at += self.out.write(table + index + np.array(footer, "<i8").tobytes() + MAGIC)
        return len(self.docs), self.n_ids, self.at


class PlaneReader:
    """Random access to the blocks of a file, and all documents in order."""

    def __init__(self, source) -> None:
        """``source``: a seekable binary file."""
        self.source, self.unpack = source, zstandard.ZstdDecompressor().decompress
        source.seek(0, 2)
        size = source.tell()
        tail = self._bytes(size - 56, 56)
        if tail[-8:] != MAGIC or self._bytes(0, 8) != MAGIC:
            raise ValueError("not a whole plane file")
        planes, blocks, docs, self.n_ids, n_table, n_index = np.frombuffer(tail[:48], "<i8").tolist()
        table = self.unpack(self._bytes(size - 56 - n_index - n_table, n_table))
        raw = self.unpack(self._bytes(size - 56 - n_index, n_index))
        self.null = np.frombuffer(table[:docs], np.uint8)
        self.doc_ids = np.frombuffer(table[docs : 9 * docs], "<i8")
        self.lengths = np.frombuffer(table[9 * docs :], "<i8")
        self.index = np.frombuffer(raw, "<i8").reshape(blocks, 2 + planes)

    def _bytes(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def block(self, k: int) -> np.ndarray:
        at, n, *sizes = self.index[k].tolist()
        raw, planes = self._bytes(at, sum(sizes)), []
        for size in sizes:
            planes.append(self.unpack(raw[:size]))
            raw = raw[size:]
        return join_planes(planes, n)

    def runs(self) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the document, some of its ids), in order; every document at least once."""
        blocks = (self.block(k) for k in range(len(self.index)))
        rest = np.empty(0, "<u4")
        for d, length in enumerate(self.lengths.tolist()):
            first = True
            while first or length:
                if length and not len(rest):
                    rest = next(blocks)
                take = min(length, len(rest))
                yield d, rest[:take]
                rest, length, first = rest[take:], length - take, False


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, bits: bool = False
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write one file for each range of doc_ids; returns the manifest.

    Other columns are ignored.  Null texts are empty, null doc_ids come first, rows with the same doc_id
    stand side by side.  A task writes under a name of its own and then moves the file to its place, so a
    repeated task replaces the same content.  ``folder`` must be shared; an empty range has no file.
    """
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(*keys).sortWithinPartitions(*keys)

    def write(batches):
        part, n = TaskContext.get().partitionId(), 0
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        attempt, ids_of = f"{root}/_attempt-{uuid.uuid4().hex}", encoder(vocabulary).many
        ending = np.array([end_id], "<u4").tobytes()
        with store.open_output_stream(attempt) as out:
            writer = PlaneWriter(out, bits)
            for piece in slices(batches, "text"):
                for doc_id, ids in zip(piece.column(0).to_pylist(), ids_of(piece.column(1).to_pylist())):
                    writer.add(doc_id, ids + ending)
            n, n_ids, size = writer.close()
        if not n:
            store.delete_file(attempt)
            return
        store.move(attempt, f"{root}/part-{part:06d}.planes")
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "n_docs": n, "n_tokens": n_ids, "n_bytes": size}],
            pa.schema([("part", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]),
        )

    return stored(ordered.mapInArrow(write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """A digest of each document as it stands in the files; a task reads one file, a block at a time.

    The driver holds two numbers for each file.
    """
    spark = manifest.sparkSession
    parts = sorted((r.part, r.n_tokens) for r in manifest.select("part", "n_tokens").collect())
    if not parts:
        return spark.createDataFrame([], DIGEST)
    numbers = [p for p, _ in parts]
    base = [0, *np.cumsum([n for _, n in parts]).tolist()]
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                with store.open_input_file(f"{root}/part-{numbers[k]:06d}.planes") as source:
                    file = PlaneReader(source)
                    crc = np.zeros(len(file.lengths), np.int64)
                    for d, ids in file.runs():
                        crc[d] = zlib.crc32(ids.tobytes(), int(crc[d]))
                    starts = base[k] + np.cumsum(file.lengths) - file.lengths
                    columns = [pa.array(file.doc_ids, mask=file.null.astype(bool)), starts, file.lengths, crc]
                    for at in range(0, len(crc), 10_000):
                        cut = [pa.array(c[at : at + 10_000]) if isinstance(c, np.ndarray) else c.slice(at, 10_000) for c in columns]
                        yield pa.RecordBatch.from_arrays(cut, schema=schema)

    return spark.range(0, len(parts), 1, len(parts)).mapInArrow(read, DIGEST)


def token_digest(docs: DataFrame, vocabulary: str | None = None, bits: bool = False) -> DataFrame:
    """Write token files of ``docs`` into the shared scratch folder and digest what they hold."""
    folder = scratch_folder(docs.sparkSession, "tokens")
    manifest = write_token_files(docs, folder, vocabulary or vocabulary_path(), bits=bits)
    return read_token_files(manifest, folder)
