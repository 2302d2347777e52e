"""Nearest neighbours by multi-index hashing: learned binary codes, an index for each of their substrings.

Codes are the signs of rotated vectors; the rotations are learned on a sample (iterative quantization).  If two
codes differ in at most ``radius`` bits, then by the pigeonhole principle one of ``m`` substrings differs in at
most ``radius // m`` bits, and all but the first ``radius % m + 1`` substrings may be asked for one bit less.
Probing the substring indexes that far finds every code within the radius.  Those are ranked by true cosines.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.llm.vectors import cosines, matrix, unit, usable

#: Bits of a code and of a substring.
BITS, PART = 256, 16
#: Vectors that rotations and radius are learned on, and of these the queries that set the radius.
SAMPLE, AUDITED = 4096, 256
#: Share of a sample query's true neighbours that the radius has to hold.
REACHED = 0.97
#: Vectors of an index and queries that meet it at once.
INDEX_ROWS, QUERY_ROWS = 8192, 2048


def rotations(sample: np.ndarray, bits: int = BITS, rounds: int = 20, seed: int = 7) -> np.ndarray:
    """A matrix of ``bits`` columns: rotations, each turned until signs lose little of the sample."""
    rng, wide = np.random.default_rng(seed), min(sample.shape[1], bits)
    axes = np.linalg.svd(sample, full_matrices=False)[2].T if len(sample) else np.eye(sample.shape[1])
    axes = np.linalg.qr(np.concatenate([axes, rng.standard_normal((sample.shape[1], wide))], axis=1))[0][:, :wide]
    low, found = sample @ axes, []
    for _ in range(-(-bits // wide)):
        turn = np.linalg.qr(rng.standard_normal((wide, wide)))[0]
        for _ in range(rounds if len(sample) else 0):
            left, _, right = np.linalg.svd(np.sign(low @ turn).T @ low)
            turn = (left @ right).T
        found.append(axes @ turn)
    return np.concatenate(found, axis=1)[:, :bits]


def codes(rows: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """The code of each row as 16-bit substrings."""
    return np.packbits(rows @ turned > 0, axis=1).view(np.uint16)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def nearest(queries: np.ndarray, q_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, q: np.ndarray, r: np.ndarray, k: int):
    """Of pairs (q, r), the k nearest rows of each query: (query, row, cosine)."""
    apart = q_ids[q] != ids[r]
    q, r = q[apart], r[apart]
    score = np.concatenate([cosines(queries[q[c : c + 65536]], rows[r[c : c + 65536]]) for c in range(0, len(q), 65536)] or [np.empty(0)])
    order = np.lexsort((ids[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    first = np.searchsorted(q, q)
    top = np.arange(len(q)) - first < k
    return q[top], r[top], score[top]


class MultiIndex:
    """Codes in one directory for each substring: its different values, and the rows that have them."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.directories = []
        for part in words.T:
            order = np.argsort(part, kind="stable")
            values, sizes = np.unique(part, return_counts=True)
            self.directories.append((values, sizes, order))

    def within(self, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (query, row) whose codes differ in at most ``radius`` bits.

        A ball of substring values can be larger than the directory, so the directory is compared with the
        query instead of enumerating the ball.
        """
        most, extra = divmod(radius, len(self.directories))
        found_q, found_r = [], []
        for at in range(0, len(asked), 64):
            some = asked[at : at + 64]
            probed = np.zeros((len(some), len(self.words)), bool)
            for k, (values, sizes, order) in enumerate(self.directories):
                bits = most if k <= extra else most - 1
                near = np.bitwise_count(values[None] ^ some[:, k, None]) <= bits if bits >= 0 else np.zeros((len(some), len(values)), bool)
                probed[:, order] |= np.repeat(near, sizes, axis=1)
            q, r = np.nonzero(probed)
            for c in range(0, len(q), 1 << 18):
                a, b = q[c : c + (1 << 18)], r[c : c + (1 << 18)]
                close = differing(some[a], self.words[b]) <= radius
                found_q.append(a[close] + at), found_r.append(b[close])
        empty = [np.empty(0, int)]
        return np.concatenate(found_q or empty), np.concatenate(found_r or empty)


def learned(sample: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Rotations, and the radius that holds REACHED of the true neighbours of some sample rows.

    Neighbours in a sample are farther than in the whole table, so there the radius holds more.
    """
    turned = rotations(sample)
    if len(sample) < 2:
        return turned, BITS
    some, words = sample[:AUDITED], codes(sample, turned)
    place = np.arange(len(sample))
    pairs = np.repeat(np.arange(len(some)), len(sample)), np.tile(place, len(some))
    q, r, _ = nearest(some, place, sample, place, *pairs, k)
    return turned, int(np.quantile(differing(words[q], words[r]), REACHED, method="higher"))


def _search(rows: DataFrame, asked: DataFrame, turned: np.ndarray, radius: int, k: int, n_rows: int, n_asked: int) -> DataFrame:
    """Candidates (query_id, vec_id, score): the k nearest of each query in each index within the radius.

    Indexes and queries meet in blocks: a task has one index and one block of queries.
    """
    indexes, blocks = -(-n_rows // INDEX_ROWS) or 1, -(-n_asked // QUERY_ROWS) or 1
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("vec_id", "vector", dealt(indexes).alias("index"), every(blocks).alias("block"))
    right = asked.select("vec_id", "vector", dealt(blocks).alias("block"), every(indexes).alias("index"))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def meet(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(rows) or not len(asked):
            return schema.empty_table()
        held, wanted = unit(matrix(rows.column("vector"))), unit(matrix(asked.column("vector")))
        ids, q_ids = rows.column("vec_id").to_numpy(), asked.column("vec_id").to_numpy()
        q, r = MultiIndex(codes(held, turned)).within(codes(wanted, turned), radius)
        q, r, score = nearest(wanted, q_ids, held, ids, q, r, k)
        return pa.table([q_ids[q], ids[r], score], schema=schema)

    keys = ["index", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")


def _of_size(rows: DataFrame, size: int, every: int, k: int) -> DataFrame:
    """Stored (query_id, vec_id, score): the k nearest ids of each query among ``rows`` (vec_id, vector) of one length.

    A query with fewer than k found within the radius is asked again with all bits.
    """
    rows = stored(rows.where(F.size("vector") == size).distinct(), "vectors")
    asked = rows.where(F.col("vec_id") % every == 0)
    n_rows, n_asked = rows.count(), asked.count()
    counts = rows.groupBy("vec_id").count().agg(F.count("*").alias("ids"), F.max("count").alias("most")).first()
    picked = rows.orderBy(F.xxhash64("vec_id"), "vector").limit(SAMPLE).select("vector").toArrow()
    # so many vectors hold k ids, however many of them are of one id
    enough = k * counts.most
    turned, radius = learned(unit(matrix(picked.column("vector"))), enough)

    def ranked(found: DataFrame) -> DataFrame:
        order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        if counts.most > 1:
            found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = stored(ranked(_search(rows, asked, turned, radius, enough, n_rows, n_asked)), "nearest")
    full = near.groupBy("query_id").count().where(F.col("count") >= min(k, counts.ids - 1)).select("query_id")
    short = stored(asked.join(full, asked.vec_id == full.query_id, "left_anti"), "short")
    n_short = short.count()
    if n_short:
        again = ranked(_search(rows, short, turned, BITS, enough, n_rows, n_short))
        near = near.join(full, "query_id", "left_semi").unionByName(again)
    return near.select("query_id", "rank", "vec_id", "score")


def search(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by cosine of each row whose vec_id divides by ``every``.

    Candidates are all rows with another vec_id.  Rows without vec_id, and vectors that are null, zero or not
    finite take no part.  Vectors of each length are searched on their own, since no cosine joins two lengths.
    Rows that share a vec_id are one item with all its different vectors: the score of two items is that of
    their nearest pair, and an item is listed once.  Equal scores go by vec_id.  An empty table gives no rows.
    """
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where("vec_id is not null").where(usable())
    sizes = sorted(r["size"] for r in rows.select(F.size("vector").alias("size")).distinct().collect())
    if not sizes:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = [_of_size(rows, size, every, k) for size in sizes]
    if len(found) == 1:
        return found[0]
    best = reduce(DataFrame.unionByName, found).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
