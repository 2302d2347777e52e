"""SimHash near-duplicates, linked exactly through vantage-point trees over fingerprints."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices, stored
from millrace.llm.components import components, local_roots

#: Words of a shingle, seed of its hash, and the differing bits up to which fingerprints link.
WORDS, SEED, RADIUS = 3, 42, 2
#: Fingerprints that a shard should hold, fingerprints that choose the shards, vantage points tried.
SHARD_ROWS, SAMPLE, TRIED = 16_384, 4096, 24
#: Points of a tree's leaf, and pairs compared at once.
LEAF, BLOCK = 64, 1 << 20


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of all word shingles, repeats included; zero without words.

    A text with fewer words is one shingle.  A bit is set if over half of the hashes have it.
    """
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends[:-1]]
    hashed = xxhash.xxh64_intdigest
    spans = zip(starts, ends[words - 1 :]) if len(found) > words else [(0, ends[-1])]
    hashes = np.fromiter((hashed(joined[p : q - 1], seed) for p, q in spans), "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        octets = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; ``fp`` holds the 64 bits as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for piece in slices(batches, "text"):
            bits = np.array([fingerprint(t) for t in piece.column(2).to_pylist()], np.uint64)
            columns = [piece.column(0), piece.column(1), pa.array(bits.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return keyed.mapInArrow(run, "doc_id long, text_hash long, fp long")


def distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


class Node(NamedTuple):
    """Inside: distance to ``vantage`` at most ``radius``.  A shard number stands for a subtree that is one shard."""

    vantage: np.uint64
    radius: int
    inside: Node | int
    outside: Node | int


def shard_tree(sample: np.ndarray, rows: int, shard_rows: int = SHARD_ROWS, reach: int = RADIUS) -> Node | int:
    """A tree over a sample whose subtrees stand for about ``shard_rows`` of ``rows`` fingerprints.

    Of several vantage points, the one with the fewest fingerprints near its median shell is taken, since
    those have to visit both sides.  What no vantage point can part stays together: so close to each other
    there are only few different fingerprints.
    """
    number = iter(range(len(sample) + 1))

    def build(points: np.ndarray) -> Node | int:
        if len(points) * rows <= shard_rows * len(sample) or len(points) < 16:
            return next(number)
        best = None
        for v in points[:: -(-len(points) // TRIED)]:
            d = distance(points, v)
            radius = int(np.median(d))
            share = (d <= radius).mean()
            near = ((d > radius - reach) & (d <= radius + reach)).mean()
            if share < 1 and near < 0.8 and (best is None or near + abs(share - 0.5) < best[0]):
                best = (near + abs(share - 0.5), v, radius, d <= radius)
        if best is None:
            return next(number)
        _, v, radius, inside = best
        return Node(v, radius, build(points[inside]), build(points[~inside]))

    return build(sample)


def visits(tree: Node | int, points: np.ndarray, reach: int = RADIUS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the point, shard, whether the shard is its home) for all shards within ``reach`` of a point."""
    found, todo = [], [(tree, np.arange(len(points)), np.ones(len(points), bool))]
    while todo:
        node, at, home = todo.pop()
        if not len(at):
            continue
        if isinstance(node, int):
            found.append((at, np.full(len(at), node), home))
            continue
        d = distance(points[at], node.vantage)
        within, into, out = d <= node.radius, d <= node.radius + reach, d > node.radius - reach
        todo += [(node.inside, at[into], (home & within)[into]), (node.outside, at[out], (home & ~within)[out])]
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int), np.empty(0, int), np.empty(0, bool))


def close_pairs(points: np.ndarray, queries: np.ndarray, reach: int = RADIUS):
    """Blocks of (place of a query, place of a point) with at most ``reach`` differing bits, exactly.

    A vantage-point tree over ``points`` that all queries descend together: a query enters a side only if
    the triangle inequality allows a point there.
    """
    todo = [(np.arange(len(points)), np.arange(len(queries)))]
    while todo:
        p, q = todo.pop()
        if not len(p) or not len(q):
            continue
        if len(p) > LEAF:
            best = None
            for v in points[p[:: -(-len(p) // 4)]]:
                d = distance(points[p], v)
                radius = int(np.median(d))
                inside = d <= radius
                if not inside.all() and (best is None or abs(inside.mean() - 0.5) < best[0]):
                    best = (abs(inside.mean() - 0.5), v, radius, inside)
            if best is not None:
                _, v, radius, inside = best
                d = distance(queries[q], v)
                todo += [(p[inside], q[d <= radius + reach]), (p[~inside], q[d > radius - reach])]
                continue
        step = max(1, BLOCK // len(p))
        for at in range(0, len(q), step):
            some = q[at : at + step]
            hit = np.nonzero(np.bitwise_count(queries[some][:, None] ^ points[p][None]) <= reach)
            yield some[hit[0]], p[hit[1]]


def shard_links(fps: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, smallest fingerprint it is joined with in this shard)."""
    mine, root = np.flatnonzero(home), np.arange(len(fps))
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged(root: np.ndarray) -> np.ndarray:
        """The forest with what was found since; pairs are dropped then."""
        a, b = (np.concatenate(x) for x in zip((np.arange(len(fps)), root), *held))
        held.clear()
        return local_roots(len(fps), a, b)

    for q, p in close_pairs(fps[mine], fps):
        apart = root[q] != root[mine[p]]
        if apart.any():
            held.append((q[apart], mine[p[apart]]))
            if sum(len(x) for x, _ in held) > BLOCK:
                root = merged(root)
    root = merged(root)
    joined = np.flatnonzero(root != np.arange(len(fps)))
    return fps[joined], fps[root[joined]]


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that join all of ``distinct`` (fp) with at most RADIUS differing bits, and no others.

    Not all pairs: within a shard a forest of them.
    """
    rows = distinct.count()
    picked = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect() if rows else []
    tree = shard_tree(np.array([r.fp for r in picked], np.int64).view(np.uint64), rows)
    schema = pa.schema([("shard", pa.int32()), ("fp", pa.int64()), ("home", pa.bool_())])

    def spread(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy()
            at, shard, home = visits(tree, fps.view(np.uint64))
            for k in range(0, len(at), 50_000):
                cut = slice(k, k + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(shard[cut], pa.int32()), pa.array(fps[at[cut]]), pa.array(home[cut])], schema=schema)

    def join(table: pa.Table) -> pa.Table:
        a, b = shard_links(table.column("fp").to_numpy().view(np.uint64), table.column("home").to_numpy())
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    shards = distinct.select("fp").mapInArrow(spread, "shard int, fp long, home boolean")
    return shards.groupBy("shard").applyInArrow(join, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, keep) for every row of ``docs`` (doc_id, text).

    Other columns are ignored.  Equal fingerprints are one node, so copies never meet in pairs.  Null and
    empty texts have fingerprint zero and link like others.  ``component_id`` is the smallest doc_id of the
    component, null only if all its doc_ids are null; rows that share a doc_id are rows of their own.
    ``keep`` marks the rows with that doc_id, among different texts of it those of the smallest hash.
    """
    every = stored(fingerprints(docs), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    nodes = stored(every.groupBy("fp").agg(first), "nodes")
    label = components(links(nodes)).withColumnsRenamed({"id": "fp"})
    placed = nodes.join(label, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = placed.groupBy("component").agg(F.min("first").alias("least"))
    found = every.join(placed.join(smallest, "component").select("fp", "least"), "fp")
    keep = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    return found.select("doc_id", "text_hash", "fp", F.col("least.doc_id").alias("component_id"), keep.alias("keep"))


def keep_one(docs: DataFrame, grouped: Callable[[DataFrame], DataFrame] = near_duplicates) -> DataFrame:
    """One row of each group of near-duplicates, with all columns of ``docs`` as they are.

    It is the row of the smallest doc_id; one of them if that row is repeated.  ``grouped`` finds the groups.
    """
    kept = stored(grouped(docs).where("keep").select("doc_id", "text_hash"), "kept")
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    mine = [F.col("row.doc_id").cast("long"), F.xxhash64("row.text")]
    match = mine[0].eqNullSafe(kept.doc_id) & (mine[1] == kept.text_hash)
    chosen = rows.join(kept, match, "left_semi")
    if not kept.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        chosen = chosen.groupBy(mine[0].alias("d"), mine[1].alias("h")).agg(F.first("row").alias("row"))
    return chosen.select(*[F.col(f"row.`{c}`").alias(c) for c in names])
