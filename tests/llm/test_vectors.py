"""Vector search and near-duplicates against all pairs."""

import collections
import math

import numpy as np
import pytest

from millrace.llm import entry, hnsw, mih
from millrace.llm.components import local_roots
from millrace.llm.vectors import unit

SF = "/root/testdata/sf0.01"
NAMES = "vec_id long, embedding array<float>, label int, vector string, node int, score double"


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    return rows, unit(np.array([r.embedding for r in rows], float))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", 1, 0.5) for i, v, k in rows], NAMES)


def test_search_of_the_table(spark, table):
    rows, unit_rows = table
    got = entry.op5_multi_index_hashing(spark, SF).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.query_id].append(r)
    asked = [r.vec_id for r in rows if r.vec_id % 50 == 0]
    assert sorted(by) == asked
    hits = 0
    for q in asked:
        score = unit_rows @ unit_rows[q]
        want = [i for i in np.lexsort((np.arange(len(score)), -score)) if i != q][:5]
        mine = sorted(by[q], key=lambda r: r.rank)
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5] and all(abs(r.score - score[r.vec_id]) < 1e-12 for r in mine)
        assert [r.vec_id for r in mine] == [r.vec_id for r in sorted(mine, key=lambda r: (-r.score, r.vec_id))]
        hits += len(set(want) & {r.vec_id for r in mine})
    assert hits >= 0.9 * 5 * len(asked)


def test_index_finds_all_codes_within_the_radius():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**16, (20, 16), dtype=np.uint16)
    words = np.concatenate([base, base ^ (rng.random((20, 16)) < 0.3).astype(np.uint16), rng.integers(0, 2**16, (400, 16), dtype=np.uint16)])
    for radius in (0, 1, 5, 16, 90, 110, 256):
        q, r = mih.MultiIndex(words).within(words[:70], radius)
        want = np.argwhere(mih.differing(words[:70, None], words[None]) <= radius)
        assert sorted(zip(q, r)) == [tuple(x) for x in want]


def test_search_of_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1.0, 0.0], 1), (50, [1.0, 1.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0], 1)]
    rows += [(5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (8, [1.0], 1), (None, [1.0, 0.0], 1), (100, [0.0, 0.0], 1), (9, [], 1)]
    got = [tuple(r) for r in mih.search(frame(spark, rows)).orderBy("query_id", "rank").collect()]
    half = pytest.approx(math.sqrt(0.5))
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 50, half), (50, 1, 0, half), (50, 2, 1, half), (50, 3, 2, half)]
    assert mih.search(frame(spark, [])).collect() == []
    assert mih.search(frame(spark, rows[:1])).collect() == []


def test_search_drops_no_vector(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4).tolist(), 1) for i in range(100)] + [(i, rng.normal(size=3).tolist(), 1) for i in range(100, 160)]
    rows += [(i, rng.normal(size=4).tolist(), 1) for i in (0, 7, 7, 50, 100, 100)] + [rows[3]] * 4
    best = collections.defaultdict(lambda: -2.0)
    for i, v, _ in rows:
        for j, w, _ in rows:
            if i % 50 == 0 and i != j and len(v) == len(w):
                a, b = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                best[i, j] = max(best[i, j], a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))
    want = []
    for q in (0, 50, 100, 150):
        near = sorted((-s, j) for (i, j), s in best.items() if i == q)[:5]
        want += [(q, k + 1, j, pytest.approx(-s)) for k, (s, j) in enumerate(near)]
    assert [tuple(r) for r in mih.search(frame(spark, rows)).orderBy("query_id", "rank").collect()] == want


def plain_links(rows, least=0.93):
    ok = [v is not None and k is not None and None not in v and all(map(math.isfinite, v)) and any(v) for _, v, k in rows]
    place = np.flatnonzero(ok)
    linked = np.zeros((len(rows), len(rows)), bool)
    for i in place:
        for j in place:
            if i != j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                linked[i, j] = a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= least
    root = local_roots(len(rows), *np.nonzero(linked))
    low = collections.defaultdict(list)
    for (i, _, _), r in zip(rows, root):
        low[r].append(i)
    label = [min((x for x in low[r] if x is not None), default=None) for r in root]
    return collections.Counter((i, int(n), c, i == c) for (i, _, _), n, c in zip(rows, linked.sum(1), label))


def as_counter(found):
    return collections.Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in found.collect())


@pytest.mark.parametrize("shard_rows", [20_000, 37])
def test_links_of_the_table(spark, table, monkeypatch, shard_rows):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", shard_rows)
    rows = [(r.vec_id, r.embedding, r.label) for r in table[0]]
    assert as_counter(entry.op10_hnsw_near_dedup(spark, SF)) == plain_links(rows)


def test_links_of_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [(i, [1.0, 0.001 * i], 1) for i in range(12)] + [(20, [1.0, 0.0], 2), (21, [5.0, 0.0], 2), (21, [5.0, 0.0], 2), (22, [-0.0, 1.0], 2), (23, [0.0, 1.0], 2)]
    rows += [(30, [1.0, 0.0], None), (31, None, 1), (32, [0.0, 0.0], 1), (33, [nan, 1.0], 1), (34, [inf, 1.0], 1), (35, [None, 1.0], 1), (36, [], 1), (37, [1.0], 1), (38, [2.0], 1), (None, [1.0, 0.0], 2), (None, None, 2)]
    assert as_counter(hnsw.near_duplicates(frame(spark, rows))) == plain_links(rows)
    assert hnsw.near_duplicates(frame(spark, [])).collect() == []


def test_graph_finds_dense_and_lonely_vectors():
    rng = np.random.default_rng(8)
    centre = rng.standard_normal((6, 32)) * 3
    rows = unit(np.concatenate([rng.standard_normal((2500, 32)), *(c + rng.standard_normal((n, 32)) * 0.1 for c, n in zip(centre, (700, 90, 30, 5, 3, 2)))]))
    rows = rows[rng.permutation(len(rows))]
    graph, order = hnsw.Graph.build(rows)
    truth = graph.rows @ graph.rows.T >= 0.93
    beam = graph.audited_beam(0.93)
    found = sum(int(truth[q, k].sum()) for q, k in graph.links(graph.rows, 0.93, beam))
    assert found >= 0.99 * truth.sum() and beam < len(rows)
    again, held = hnsw.Graph.from_bytes(graph.to_bytes(order=order))
    assert held["order"].tolist() == order.tolist() and [x.tolist() for x in again.layers] == [x.tolist() for x in graph.layers]
