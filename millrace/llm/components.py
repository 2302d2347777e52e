"""Connected components of a graph that no single machine can hold."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and edges (a, b): the smallest node of each node's component."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(jumped := root[root], root):
            root = jumped
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _neighbour_minimum(pairs: DataFrame) -> DataFrame:
    """(u, v, m) with the smallest m of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _neighbour_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    met = _neighbour_minimum(edges)
    down = met.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(met.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges`` (two long columns), component its smallest reachable node.

    Large-star and small-star in turn until nothing changes.  Every round is written to the shared folder;
    edges to a hub meet its minimum in a join that adaptive execution can split, and duplicates are removed
    before they are shuffled.  Loops and rows with a null are left out.
    """
    a, b = edges.columns[:2]
    now = edges.dropna(subset=[a, b]).select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
    now = stored(now.where("u > v").distinct(), "edges")
    mark = F.struct(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = None
    while (state := tuple(now.agg(mark.alias("s")).first().s)) != before:
        before = state
        now = stored(_small_star(_large_star(now)), "edges")
    leaves = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
