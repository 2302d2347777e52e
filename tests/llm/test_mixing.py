"""Budgets and prefixes against plain code and SQL."""

import collections
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import entry, mixing

from .conftest import SF


def plain_share(children, budget):
    """{name: budget} of {name: (cap, weight)}: whole shares for those that can give no more, again and again."""
    out, open_ = {}, {n: c for n, c in children.items() if c[1] > 0}
    while open_:
        weights = sum(w for _, w in open_.values())
        full = {n for n, (cap, w) in open_.items() if cap * weights <= budget * w}
        if not full:
            return out | {n: budget * w // weights for n, (_, w) in open_.items()}
        name = min(full, key=lambda n: (open_[n][0] / open_[n][1], n))
        out[name] = open_.pop(name)[0]
        budget -= out[name]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_budgets_go_down_the_tree(spark, seed):
    rng = random.Random(seed)
    leaves = {(d, x, f"s{s}"): rng.randint(0, 900) for d in ("web", "books", "zoo") for x in ("en", "de", "fr")[: rng.randint(1, 3)] for s in range(rng.randint(1, 4))}
    weights = {"domain": {"web": 5, "books": 2, "zoo": 0 if seed == 3 else 1}, "lang": {"en": 3}, "source": {"s1": 4}}
    budget, epochs = sum(leaves.values()) * rng.choice((1, 3)) // 2, rng.choice((1, 2))
    frame = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, tokens long")
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(frame, mixing.LEVELS, weights, budget, epochs).collect()}
    want, given = {}, {(): budget}
    for depth, level in enumerate(mixing.LEVELS):
        caps = collections.Counter()
        for k, v in leaves.items():
            caps[k[: depth + 1]] += v * epochs
        below = {}
        for parent in {k[:depth] for k in caps}:
            children = {k: (c, weights[level].get(k[-1], 1)) for k, c in caps.items() if k[:depth] == parent}
            below |= plain_share(children, given.get(parent, 0))
        given = want = below
    assert got == {k: want.get(k, 0) for k in leaves}
    assert sum(got.values()) <= budget


def test_rows_of_the_table_are_those_of_the_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.sql(entry.SQL["op6_hierarchical_mixing"])
    got = entry.op6_hierarchical_mixing(spark, SF)
    assert got.columns == want.columns
    rows = collections.Counter(map(tuple, got.collect()))
    assert rows == collections.Counter(want.fetchall())
    assert {r[-1] for r in rows} == {0, 1}


def test_no_python_on_the_way(spark):
    plan = entry.op6_hierarchical_mixing(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("few", [0, 100_000])
def test_prefixes_of_odd_rows(spark, monkeypatch, few):
    monkeypatch.setattr(mixing, "FEW_LEAVES", few)
    rows = [(i, f"word {i} " * (i % 5), "en" if i % 2 else None, f"src{i % 4}") for i in range(60)]
    rows += [(None, "no id", "en", None), (5, None, "fr", "nine"), (7, "twice", "en", "src1"), (7, "twice", "en", "src1"), (8, "", "de", "src99999999999999999999")]
    docs = spark.createDataFrame([(d, t, x, s, 1, "t", 0) for d, t, x, s in rows], "doc_id long, text string, lang string, source string, n_chars long, tokens string, epoch int")
    got = mixing.mixture(docs, percent=70, epochs=3).collect()
    by = collections.defaultdict(list)
    for d, t, x, s in rows:
        domain = "other" if s in (None, "nine") else ("web", "books", "code")[int(s[3:]) % 3 if len(s) < 12 else 999999999999999999 % 3]
        by[domain, x or "(none)", s or "(none)"].append((d, t or ""))
    frame = spark.createDataFrame([(*k, sum(len(t.split()) for _, t in v)) for k, v in by.items()], "domain string, lang string, source string, tokens long")
    total = sum(len((t or "").split()) for _, t, _, _ in rows)
    want = collections.Counter()
    for r in mixing.budgets(frame, mixing.LEVELS, mixing.WEIGHTS, total * 70 // 100, 3).where("tokens > 0").collect():
        whole = min(r.budget // r.tokens, 3)
        key = lambda d, t: hashlib.md5(f"17:{whole}:{'' if d is None else d}:{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()
        left, docs_of_leaf = r.budget - whole * r.tokens if whole < 3 else 0, by[r.domain, r.lang, r.source]
        for d, t in docs_of_leaf:
            upto = sum(len(b.split()) for a, b in docs_of_leaf if key(a, b) <= key(d, t))
            for epoch in range(whole + (0 < left and upto <= left)):
                want[d, r.domain, r.lang, r.source, len(t.split()), epoch] += 1
    assert collections.Counter(map(tuple, got)) == want
    assert mixing.mixture(docs.limit(0)).collect() == []
    kept = mixing.keep_mixed(docs, 80)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows) and kept.exceptAll(docs).count() == 0
    assert kept.select(F.sum(mixing.word_tokens())).first()[0] <= 0.8 * total
