"""Near-duplicate vectors by navigable small-world graphs, one graph for each shard.

Every shard of a label is built into a hierarchical graph; every vector of the label is sent through every one
of its shards.  A beam that ends in vectors that all link is widened, and audits against all vectors of the
shard widen all beams until they find what there is.  Links are counted by true cosines.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.llm.components import components, local_roots
from millrace.llm.vectors import cosines, matrix, unit, usable

LEAST_COSINE = 0.93
#: Vectors of a shard, and of a block of queries that meets it.
SHARD_ROWS = 20_000
#: Neighbours of a node in the upper layers (twice as many below), beam while building and first beam.
LINKS, BUILD_BEAM, BEAM = 16, 64, 48
#: Queries of an audit and the share of their links that a beam has to find.
AUDITED, REACHED = 100, 0.995
#: Queries that walk side by side, and labels up to which their counts are broadcast.
ABREAST, FEW_LABELS = 256, 100_000


class Graph:
    """Layers over vectors in descending order of their level: layer ``k`` holds the first of them.

    ``layers[k]`` has the neighbours of its nodes, -1 where there are fewer.
    """

    def __init__(self, rows: np.ndarray, layers: list[np.ndarray]) -> None:
        self.rows, self.layers = rows, layers

    @classmethod
    def build(cls, rows: np.ndarray, seed: int = 5) -> tuple[Graph, np.ndarray]:
        """The graph, and the place in ``rows`` of each of its nodes."""
        rng = np.random.default_rng(seed)
        level = (-np.log(1 - rng.random(len(rows))) / np.log(LINKS)).astype(int)
        order = np.argsort(-level, kind="stable")
        level = level[order]
        sizes = [int((level >= k).sum()) for k in range(int(level.max(initial=0)) + 1)]
        layers = [np.full((n, LINKS * (2 if k == 0 else 1)), -1, np.int32) for k, n in enumerate(sizes)]
        graph = cls(rows[order].astype(np.float32), layers)
        done = 0
        while done < len(rows):
            more = min(len(rows) - done, max(64, min(done, 1024)))
            graph._insert(done, more)
            done += more
        return graph, order

    def _insert(self, done: int, more: int) -> None:
        """Link nodes ``done`` .. ``done + more`` with earlier ones and with each other, from the top down."""
        new = np.arange(done, done + more)
        entry = np.zeros((more, 1), np.int64) if done else None
        for layer in reversed(self.layers):
            mine = new[new < len(layer)]
            if entry is not None:
                found, sims = self.walk(layer, self.rows[new], entry, BUILD_BEAM, min(done, len(layer)))
                entry = found[:, :4]
            if not len(mine):
                continue
            among = self.rows[mine] @ self.rows[mine].T
            np.fill_diagonal(among, -2)
            peers = np.argsort(-among, axis=1)[:, : LINKS * 2]
            near, score = mine[peers], np.take_along_axis(among, peers, 1)
            if entry is not None:
                near = np.concatenate([found[: len(mine)], near], axis=1)
                score = np.concatenate([sims[: len(mine)], score], axis=1)
            near = np.where(score > -2, near, -1)
            chosen = self._chosen(near, score, layer.shape[1])
            layer[mine] = chosen
            self._back(layer, mine, chosen)

    def _chosen(self, near: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
        """``most`` of the candidates of each row: half of them by direction, the rest by nearness.

        By direction: those nearer to the node than to any neighbour that was taken before.  They keep ways
        open that lead out of dense groups.
        """
        order = np.argsort(-score, axis=1, kind="stable")[:, : 3 * most]
        near, score = np.take_along_axis(near, order, 1), np.take_along_axis(score, order, 1)
        out = np.empty((len(near), most), np.int32)
        for at in range(0, len(near), ABREAST):
            some, sims = near[at : at + ABREAST], score[at : at + ABREAST]
            vectors = self.rows[some]
            between = vectors @ vectors.transpose(0, 2, 1)
            taken = np.zeros(some.shape, bool)
            for c in range(some.shape[1]):
                closer = (between[:, c] >= sims[:, c, None]) & taken
                taken[:, c] = ~closer.any(1) & (some[:, c] >= 0) & (taken.sum(1) < most // 2)
            rank = np.where(some < 0, 2.0, np.where(taken, -2.0, -sims))
            best = np.argsort(rank, axis=1, kind="stable")[:, :most]
            picked = np.take_along_axis(some, best, 1)
            out[at : at + ABREAST, : picked.shape[1]] = picked
            out[at : at + ABREAST, picked.shape[1] :] = -1
        return out

    def _back(self, layer: np.ndarray, mine: np.ndarray, chosen: np.ndarray) -> None:
        """Links in the other direction; a node that gets too many chooses again."""
        source, target = np.repeat(mine, chosen.shape[1]), chosen.ravel()
        real = target >= 0
        source, target = source[real], target[real]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, begin, counts = np.unique(target, return_index=True, return_counts=True)
        most = layer.shape[1]
        for width in (most, 8 * most, len(mine)):  # few nodes get very many links
            fit = (counts <= width) & (counts > 0)
            if fit.any():
                at = begin[fit, None] + np.arange(int(counts[fit].max()))
                inside = np.arange(at.shape[1]) < counts[fit, None]
                extra = np.where(inside, source[np.minimum(at, len(source) - 1)], -1)
                both = np.concatenate([layer[nodes[fit]], extra], axis=1)
                twice = np.sort(both, axis=1)
                again = np.concatenate([np.zeros((len(both), 1), bool), twice[:, 1:] == twice[:, :-1]], axis=1)
                both = np.where(again, -1, twice)
                for c in range(0, len(both), ABREAST):
                    some = both[c : c + ABREAST]
                    own = self.rows[nodes[fit][c : c + ABREAST]]
                    sims = np.where(some >= 0, np.einsum("nd,nkd->nk", own, self.rows[some]), -2)
                    layer[nodes[fit][c : c + ABREAST]] = self._chosen(some, sims, most)
                counts[fit] = 0

    def walk(self, layer: np.ndarray, asked: np.ndarray, entry: np.ndarray, beam: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best nodes of each query that a best-first walk meets, with their similarity.

        Only the first ``n`` nodes count.  Places that stay free hold node -1 and similarity -2.
        """
        ids = np.full((len(asked), beam), -1, np.int64)
        sims = np.full((len(asked), beam), -2, np.float32)
        for at in range(0, len(asked), ABREAST):
            cut = slice(at, at + ABREAST)
            ids[cut], sims[cut] = self._walk(layer, asked[cut], entry[cut], beam, n)
        return ids, sims

    def _walk(self, layer, asked, entry, beam, n):
        count, step = len(asked), max(2, beam // 24)
        ids = np.full((count, beam), -1, np.int64)
        sims = np.full((count, beam), -2, np.float32)
        fresh = np.zeros((count, beam), bool)  # not looked at from here yet
        seen = np.zeros((count, n + 1), bool)  # the last column stands for "no node"
        seen[:, n] = True
        alive, new = np.arange(count), entry
        while len(alive):
            new = np.sort(np.where((new >= 0) & (new < n), new, n), axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = n
            new = np.where(seen[alive[:, None], new], n, new)
            seen[alive[:, None], new] = True
            real = new < n
            score = np.einsum("nd,nkd->nk", asked[alive], self.rows[np.where(real, new, 0)])
            score = np.where(real, score, -2).astype(np.float32)
            all_ids = np.concatenate([ids[alive], np.where(real, new, -1)], axis=1)
            all_sims = np.concatenate([sims[alive], score], axis=1)
            all_fresh = np.concatenate([fresh[alive], real], axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            now_ids, now_fresh = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_fresh, best, 1)
            turn = now_fresh & (np.cumsum(now_fresh, axis=1) <= step)
            ids[alive], sims[alive], fresh[alive] = now_ids, np.take_along_axis(all_sims, best, 1), now_fresh & ~turn
            going = turn.any(1)
            alive, turn, now_ids = alive[going], turn[going], now_ids[going]
            where = np.argsort(~turn, axis=1, kind="stable")[:, :step]
            chosen = np.where(np.take_along_axis(turn, where, 1), np.take_along_axis(now_ids, where, 1), -1)
            new = np.where(chosen[:, :, None] >= 0, layer[chosen], -1).reshape(len(alive), layer.shape[1] * chosen.shape[1])
        return ids, sims

    def search(self, asked: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest nodes found from the top layer down."""
        entry = np.zeros((len(asked), 1), np.int64)
        for layer in reversed(self.layers[1:]):
            entry = self.walk(layer, asked, entry, 16, len(layer))[0][:, :4]
        return self.walk(self.layers[0], asked, entry, beam, len(self.rows))

    def links(self, asked: np.ndarray, least: float, beam: int):
        """Blocks of (query, node) that may link; a beam that is full of them is doubled."""
        n, slack = len(self.rows), least - 1e-4
        for at in range(0, len(asked), ABREAST):
            open_, width = np.arange(at, min(at + ABREAST, len(asked))), min(beam, n)
            while len(open_):
                if width >= n:  # everything
                    q, node = np.nonzero(asked[open_] @ self.rows.T >= slack)
                    yield open_[q], node
                    break
                ids, sims = self.search(asked[open_], width)
                full = sims[:, -1] >= slack
                q, k = np.nonzero((sims >= slack) & ~full[:, None])
                yield open_[q], ids[q, k]
                open_, width = open_[full], min(n, 4 * width)

    def audited_beam(self, least: float, beam: int = BEAM) -> int:
        """A beam with which nodes find their links in this shard, measured against all of its vectors."""
        some = self.rows[:: -(-len(self.rows) // AUDITED)]
        wanted = int((some @ self.rows.T >= least).sum())
        while beam < len(self.rows):
            found = 0
            for q, node in self.links(some, least, beam):
                found += int((cosines(some[q], self.rows[node]) >= least).sum())
            if found >= REACHED * wanted:
                break
            beam *= 2
        return beam

    def to_bytes(self, **more: np.ndarray) -> bytes:
        out = io.BytesIO()
        np.savez(out, rows=self.rows, **{f"layer{k}": x for k, x in enumerate(self.layers)}, **more)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes):
        held = np.load(io.BytesIO(raw))
        return cls(held["rows"], [held[f"layer{k}"] for k in range(sum(x.startswith("layer") for x in held.files))]), held


def _graphs(nodes: DataFrame, least: float) -> DataFrame:
    """(label, shard, graph) of every shard."""

    def build(group: pa.Table) -> pa.Table:
        rows = unit(matrix(group.column("vector")))
        graph, order = Graph.build(rows)
        ids, copies = (group.column(c).to_numpy()[order] for c in ("node", "copies"))
        raw = graph.to_bytes(exact=rows[order], ids=ids, copies=copies, beam=np.array(graph.audited_beam(least)))
        return pa.table({"label": group.column("label")[:1], "shard": group.column("shard")[:1], "graph": pa.array([raw], pa.large_binary())}).cast(
            pa.schema([("label", pa.string()), ("shard", pa.int32()), ("graph", pa.binary())])
        )

    return nodes.groupBy("label", "shard").applyInArrow(build, "label string, shard int, graph binary")


def _found(asked: DataFrame, graphs: DataFrame, least: float) -> DataFrame:
    """(node, found, root): linked vectors of a query in a shard, and a node that it is joined with."""
    schema = pa.schema([("node", pa.int64()), ("found", pa.int64()), ("root", pa.int64())])

    def meet(queries: pa.Table, graphs: pa.Table) -> pa.Table:
        if not len(queries) or not len(graphs):
            return schema.empty_table()
        graph, held = Graph.from_bytes(graphs.column("graph")[0].as_py())
        exact, ids, copies = held["exact"], held["ids"], held["copies"]
        own, rows = queries.column("node").to_numpy(), unit(matrix(queries.column("vector")))
        names, places = np.unique(np.concatenate([own, ids]), return_inverse=True)
        mine, theirs = places[: len(own)], places[len(own) :]
        counts, root = np.zeros(len(own), np.int64), np.arange(len(names))
        for q, node in graph.links(rows.astype(np.float32), least, int(held["beam"])):
            score = np.concatenate([cosines(rows[q[c : c + 65536]], exact[node[c : c + 65536]]) for c in range(0, len(q), 65536)] or [np.empty(0)])
            true = (score >= least) & (own[q] != ids[node])
            q, node = q[true], node[true]
            np.add.at(counts, q, copies[node])
            apart = root[mine[q]] != root[theirs[node]]
            if apart.any():
                a, b = mine[q[apart]], theirs[node[apart]]
                root = local_roots(len(names), np.concatenate([np.arange(len(names)), a]), np.concatenate([root, b]))
        joined = np.flatnonzero(root != np.arange(len(names)))
        out_node, out_root = np.concatenate([own, names[joined]]), np.concatenate([own, names[root[joined]]])
        return pa.table([out_node, np.concatenate([counts, np.zeros(len(joined), np.int64)]), out_root], schema=schema)

    keys = ["label", "shard", "block"]
    return asked.groupBy(*keys).cogroup(graphs.groupBy(*keys)).applyInArrow(meet, "node long, found long, root long")


def near_duplicates(embeddings: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``embeddings`` (vec_id, embedding, label).

    Vectors of the same label link from cosine ``least`` on.  A null label, and vectors that are null, zero or
    not finite, link with nothing; neither do vectors of different lengths.  Equal vectors are one node with a
    number of copies, so a large group of them costs nothing.  Rows that share a vec_id are rows of their own;
    a row without vec_id counts as a link, and has the component of the others.  Other columns are ignored.
    """
    vector = F.col("embedding").cast("array<double>").alias("vector")
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), vector)
    rows = rows.withColumn("takes_part", usable() & F.col("label").isNotNull())
    part = rows.where("takes_part").withColumn("label", F.concat_ws(":", F.size("vector"), "label"))
    classes = part.groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    sizes = classes.groupBy("label").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("shards"))
    sizes = F.broadcast(sizes) if sizes.count() <= FEW_LABELS else sizes
    sharded = classes.join(sizes, "label").withColumn("shard", F.pmod(F.xxhash64("node"), "shards").cast("int"))
    graphs = stored(_graphs(sharded.select("label", "shard", "node", "copies", "vector"), least), "graphs")
    block, every = F.col("shard").alias("block"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    asked = sharded.select("label", "node", "vector", block, every.alias("shard"))
    spread = graphs.join(sizes, "label").select("label", "shard", "graph", every.alias("block"))
    found = stored(_found(asked, spread, least), "links")
    counts = found.groupBy("node").agg(F.sum("found").alias("found"))
    label = components(found.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    placed = classes.join(counts, "node").join(label.withColumnsRenamed({"id": "node"}), "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = placed.join(smallest, "component")
    answers = placed.select("label", "vector", (F.col("found") + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = part.join(answers, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not takes_part").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
