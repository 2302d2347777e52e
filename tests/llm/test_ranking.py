"""Ranked search against the scores of all pairs."""

import collections
import math
import re

import numpy as np

from millrace.llm import entry, ranking

from .conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, top=50):
    held = [(d, collections.Counter(TERM.findall((t or "").translate(UPPER)))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = collections.Counter(t for _, c in held for t in c)
    wanted = collections.defaultdict(set)
    for i, t in items:
        wanted[i] |= set(TERM.findall((t or "").translate(UPPER)))
    rows = collections.Counter()
    for i, terms in wanted.items():
        scored = []
        for (d, c), n in zip(held, sizes):
            m = 100 - 50 + 50 * n * n_docs // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, d is not None, d))
        for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top]):
            rows[i, r + 1, d, -s] += 1
    return rows


def check(got, docs, items, top=50):
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert collections.Counter(map(tuple, got.collect())) == plain(docs, items, top)


def test_ranking_of_the_table(spark):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    check(entry.op13_ranked_search(spark, SF), docs, items)


def test_odd_rows_small_pieces_and_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(ranking, "PIECE_DOCS", 5)
    monkeypatch.setattr(ranking, "BLOCK_TERMS", 4)
    rng = np.random.default_rng(1)
    docs = [(1, None), (2, ""), (3, "... \x00 --"), (None, "Alpha beta"), (None, "alpha"), (4, "ÄÖ ALPHA k\x7fK"), (5, "same copy alpha")] + [(6, "same copy alpha")] * 70
    docs += [(100 + k, " ".join(f"w{x}" for x in rng.zipf(1.3, 30))) for k in range(200)] + [(9, "beta gamma\n" * 30000)]
    items = [(1, "alpha beta"), (2, None), (3, "copy, SAME! öä K äö"), (3, "w1"), (4, "w1 w2 w3 w4 w5 w9 w40 w77"), (None, "gamma w2"), (5, "absent"), (6, "alpha beta"), (6, "alpha beta")]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, term string, score int")
    check(ranking.ranked_search(docs_of(docs), frame), docs, items)
    check(ranking.ranked_search(docs_of(docs), frame, 3), docs, items, 3)
    check(ranking.ranked_search(docs_of([]), frame), [], items)
    check(ranking.ranked_search(docs_of(docs), frame.limit(0)), docs, [])


def test_no_accumulators_are_begun_when_bounds_are_low(monkeypatch):
    rng = np.random.default_rng(2)
    n_docs, sizes = 4000, [3, 60, 70, 900, 3000, 3900, 4000]
    lists = [np.sort(rng.choice(n_docs, n, replace=False)) for n in sizes]
    gains = [rng.integers(1, g, n) for n, g in zip(sizes, (90000, 60000, 50000, 900, 70, 9, 5))]
    offsets = np.append(0, np.cumsum(sizes))
    queries = [np.arange(7), np.array([1, 2, 4]), np.array([], int), np.array([0]), np.arange(3, 7)]
    q, at, score = ranking.rank_piece(offsets, np.concatenate(lists), np.concatenate(gains), queries)
    for k, terms in enumerate(queries):
        whole = np.zeros(n_docs, int)
        for t in terms:
            np.add.at(whole, lists[t], gains[t])
        best = sorted((-s, d) for d, s in enumerate(whole) if s)[:50]
        assert sorted(zip((-score[q == k]).tolist(), at[q == k].tolist())) == best
