"""Best-fit packing of documents into token sequences, planned on the histogram of lengths."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import slices, stored
from millrace.llm.tokens import encoder, vocabulary_path

#: Tokens of a sequence.
CAPACITY = 2048
#: Appended to every document.
END_ID = 0
#: Pieces of one length that are ranked in one task at most; fewer if that leaves partitions idle.
RANK_ROWS = 50_000

PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def plan_slots(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows of (length, first rank, pieces, first sequence, offset).

    Piece ``first rank + i`` of that length goes to ``first sequence + i`` at ``offset``.  Sequences that
    are filled alike are one entry with a count, so time and size depend on the number of lengths, not on
    the number of pieces.
    """
    free: dict[int, list[tuple[int, int]]] = {}  # free tokens -> (first sequence, sequences)
    sizes: list[int] = []  # the keys of free, ascending
    plan, n_sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit in {capacity}")
        while left:
            k = bisect.bisect_left(sizes, length)
            if k < len(sizes):
                room = sizes[k]
                first, count = free[room].pop()
                if not free[room]:
                    del free[room], sizes[k]
            else:
                room, first, count = capacity, n_sequences, -(-left // (capacity // length))
                n_sequences += count
            take = min(count, left)
            plan.append((length, rank, take, first, capacity - room))
            rank, left = rank + take, left - take
            for rest, begin, n in ((room - length, first, take), (room, first + take, count - take)):
                if rest and n:
                    if rest not in free:
                        bisect.insort(sizes, rest)
                        free[rest] = []
                    free[rest].append((begin, n))
    return plan


def token_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """The pieces of each row's ids: documents of up to ``capacity`` ids whole, longer ones cut.

    A cut document has pieces of exactly ``capacity`` ids behind a first one that may be shorter.  Null
    texts are empty documents: the end id alone.  ``row`` tells apart rows of the same doc_id.  With
    ``keep_ids`` the ids come along as ``ids array<int>``.
    """
    path = vocabulary or vocabulary_path()
    fields = [("doc_id", pa.int64()), ("row", pa.int64()), ("piece", pa.int32()), ("start", pa.int64())]
    fields += [("length", pa.int64()), ("ids_crc32", pa.int64()), *([("ids", pa.list_(pa.int32()))] * keep_ids)]
    schema = pa.schema(fields)

    def cut(batches):
        ids_of, ending = encoder(path).many, np.array([END_ID], "<u4").tobytes()
        for batch in slices(batches, "text"):
            rows = []
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for (doc_id, row), ids in zip(keys, ids_of(batch.column(2).to_pylist())):
                ids += ending
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n, capacity), n] if n > capacity else [0, n]
                for k, (p, q) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[4 * p : 4 * q]
                    values = (doc_id, row, k, p, q - p, zlib.crc32(part))
                    rows.append((*values, np.frombuffer(part, "<i4")) if keep_ids else values)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    keyed = docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"), "text")
    return keyed.mapInArrow(cut, PIECES + ", ids array<int>" * keep_ids)


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Pieces are ranked within their length by ``order``, and rank ``r`` takes the planned slot ``r`` of the
    length.  A length may hold any share of the rows: pieces are dealt to (length, salt) by a hash of
    ``order``, ranked there, and moved up by the counts of the salts before.  Rows that are equal in
    ``order`` share a salt, so ``order`` should tell rows apart.  ``pieces`` is read twice: store it first.
    """
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_slots(histogram, capacity)
    most = max(histogram.values(), default=1)
    salts = max(-(-most // RANK_ROWS), min(most, int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    before = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    sums = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    base = sums.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = W.partitionBy("length", "_salt").orderBy(*order)
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(base, ["length", "_salt"])

    lengths, ranks, _, sequences, offsets = np.array(plan or np.empty((0, 5)), np.int64).T
    keys = np.lexsort((ranks, lengths))
    begin = np.stack([lengths, ranks], axis=1)[keys]
    sequences, offsets = sequences[keys], offsets[keys]
    edges = np.searchsorted(begin[:, 0], np.arange(capacity + 2))

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "_at"))
            slot = np.empty(len(length), np.int64)
            for n in np.unique(length):
                mine = length == n
                lo, hi = edges[n], edges[n + 1]
                slot[mine] = lo + np.searchsorted(begin[lo:hi, 1], rank[mine], side="right") - 1
            kept = [i for i, f in enumerate(batch.schema) if f.name != "_at"]
            new = [pa.array(sequences[slot] + rank - begin[slot, 1]), pa.array(offsets[slot])]
            names = [batch.schema.names[i] for i in kept] + ["sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in kept] + new, names=names)

    placed = ranked.select(*pieces.columns, (F.col("_rank") + F.col("_base")).alias("_at"))
    schema = pieces.schema.simpleString()[7:-1] + ",sequence_id:bigint,offset:bigint"
    return placed.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack every row of ``docs`` (doc_id, text); other columns are ignored.

    One row per piece with its sequence and offset, ``ids`` too if wanted.  Rows with equal or null doc_ids
    are packed each for itself; an empty table gives no rows.
    """
    pieces = stored(token_pieces(docs, vocabulary, capacity, keep_ids), "pieces")
    return pack(pieces, ["doc_id", "row", "piece"], capacity).drop("row")
