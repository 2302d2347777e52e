"""The prefix tree against plain dictionaries of whole prefixes."""

import collections
import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from millrace.llm import entry, trie

from .conftest import SF

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, splice=True):
    """Nodes of rows (conv_id, turn, role, text)."""
    turns = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(found)] for c, found in turns.items()}
    convs = dict(own)
    if splice:
        for c in own:
            h = zlib.crc32(str(c).encode()) % 4
            base = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])
            convs[c] = base[:h] + own[c][h:]
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
        ends[tuple(convs[c])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * words
    digest = {p: hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest() for p in members}
    return collections.Counter(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], digest[p]) for p, m in members.items()
    )


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({"pos": F.lit("x"), "node": F.lit(1), "depth": F.lit(None).cast("long"), "goes": F.lit(True)})


def rows_of(df):
    assert df.columns == COLUMNS
    return collections.Counter(map(tuple, df.collect()))


def test_nodes_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(entry.op11_prefix_trie(spark, SF)) == plain(rows)


def test_odd_rows(spark):
    rows = [(0, 0, "user", "a b"), (0, 1, None, "c"), (0, None, "system", None), (0, 1, "x", "y\x0bz q"), (3, 5, "user", "tail"), (3, 5, "user", "tail")]
    rows += [(None, 0, "user", "nobody"), (41, 0, "user", "short"), (59, 0, "user", ""), (-7, 0, "user", "minus"), (-7, 1, "user", "one"), (-20, 0, "u", "s")]
    rows += [(c, t, "ab"[t % 2], f"w{t} " * 3) for c in (60, 61, 62, 63, 75) for t in range(5)]
    rows += [(c, t, "user", "same" * ((t or 0) + 1)) for c in range(5000, 5003) for t in (0, 0, None)]
    rows += [(c, 0, "user", "common") for c in range(8000, 17000, 20)] + [(100, 0, "user", "w " * 40000)]
    assert rows_of(trie.conversation_trie(frame(spark, rows))) == plain(rows)
    assert rows_of(trie.conversation_trie(frame(spark, []))) == {}


def test_long_chains_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 7)
    rng = random.Random(5)
    rows = [(0, t, "u", f"{t}") for t in range(300)]
    for c in range(1, 40):
        rows += [(c, t, "u", f"{t}" if t < rng.randint(0, 300) else f"{c} {t}") for t in range(rng.randint(0, 60))]
    turns = trie.ordered_turns(frame(spark, rows))
    members = turns.groupBy("conv_id").agg(F.max("pos").alias("length"))
    assert rows_of(trie.prefix_trie(turns, members)) == plain(rows, splice=False)


def test_sums_of_random_trees(spark):
    rng = random.Random(6)
    for n, reach in ((1, 1), (200, 2), (200, 200)):
        parent = [None] + [rng.randint(max(0, i - reach), i - 1) for i in range(1, n)]
        depth = [0] * n
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        value = [rng.randint(-5, 9) for _ in range(n)]
        want = list(value)
        for i in range(n - 1, 0, -1):
            want[parent[i]] += want[i]
        node = lambda i: None if i is None else (i * 7919, -i)
        nodes = spark.createDataFrame([(node(i), node(parent[i]), depth[i], value[i]) for i in range(n)], "node struct<a:long,b:long>, parent struct<a:long,b:long>, depth long, v long")
        assert {r.node.a // 7919: r.v for r in trie.subtree_sums(nodes, ["v"]).collect()} == dict(enumerate(want))
