"""SimHash links and components against all pairs."""

import collections
import random

import numpy as np
import xxhash

from millrace.llm import components, entry, simhash

from .conftest import SF


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(keys, near):
    parent = list(range(len(keys)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if near(i, j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = collections.defaultdict(list)
    for i in range(len(keys)):
        groups[find(i)].append(keys[i])
    return [min((k for k in groups[find(i)] if k is not None), default=None) for i in range(len(keys))]


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    label = plain_components([d for d, _ in rows], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    return collections.Counter((d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, label))


def test_components_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = entry.op8_simhash_near_dedup(spark, SF)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert collections.Counter(map(tuple, got.collect())) == expected(rows)


def test_odd_rows(spark, docs_of):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Ä b"), (5, "ä B"), (None, base), (None, "one two"), (9, base), (9, base), (9, "a b c d"), (7, base.replace("w7 ", "w8 ")), (11, "x\x0by\x85z q"), (12, "w " * 9000)]
    found = simhash.near_duplicates(docs_of(rows)).collect()
    assert collections.Counter((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in found) == expected(rows)
    kept = simhash.keep_one(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(left) == len({c for _, _, c in expected(rows)} | {"none"}) and (None, "one two") in left and (None, base) not in left
    assert simhash.near_duplicates(docs_of([])).collect() == []


def test_shards_find_every_link(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 400, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (4, 400)).astype(np.uint64)
    points = np.unique(np.concatenate([base, base ^ flips[0], base ^ flips[0] ^ flips[1], base[:20] ^ flips[2, :20] ^ flips[3, :20], base[0] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))]))
    tree = simhash.shard_tree(rng.permutation(points)[:300], len(points), 150)
    at, shard, home = simhash.visits(tree, points)
    assert np.bincount(at[home], minlength=len(points)).tolist() == [1] * len(points) and shard.max() > 3
    a, b = [], []
    for s in np.unique(shard):
        mine = shard == s
        x, y = simhash.shard_links(points[at[mine]], home[mine])
        a.append(np.searchsorted(points, x)), b.append(np.searchsorted(points, y))
    got = components.local_roots(len(points), np.concatenate(a), np.concatenate(b))
    i, j = np.nonzero(np.bitwise_count(points[:, None] ^ points) <= 2)
    assert got.tolist() == components.local_roots(len(points), i, j).tolist()


def test_components_of_graphs(spark):
    rng = random.Random(4)
    for n, m in ((1, 0), (60, 50), (300, 260)):
        pairs = [(rng.randint(-n, n), rng.randint(-n, n)) for _ in range(m)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, 5001 + k) for k in range(80)]
        edges = spark.createDataFrame([*pairs, (None, 3), (7, 7)], "a long, b long")
        nodes = sorted({x for p in pairs if p[0] != p[1] for x in p})
        place = {x: i for i, x in enumerate(nodes)}
        a, b = (np.array([place[p[k]] for p in pairs if p[0] != p[1]], int) for k in (0, 1))
        want = {x: nodes[r] for x, r in zip(nodes, components.local_roots(len(nodes), a, b))}
        assert {r.id: r.component for r in components.components(edges).collect()} == want
