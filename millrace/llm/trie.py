"""Prefix tree of conversations, its subtree totals found by parallel tree contraction."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import stored

#: Turns of one conversation that are scanned in one group at most.
CHUNK = 1 << 14
#: Conversations whose numbers are joined to one string: those that differ in their last bits only.
ID_BITS = 12
#: Words of a text.
WORD = r"[^\x20\x09-\x0D]+"


def _root() -> Column:
    """The name of the root, where no turn has been hashed."""
    return F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, mark, words) of every row, ``pos`` from 1 in the order of ``turn``, null first.

    ``mark`` is an MD5 of role and text, null ones as empty; rows that share a turn are ordered by it, so
    repeated rows are turns of their own.  Rows without a conv_id are in no conversation.  Rows are sorted
    by ranges of (conv_id, turn, mark), so a long conversation is numbered in several tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    mark = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("mark")]
    rows = conversations.where("conv_id is not null")
    rows = rows.select(F.col("conv_id").cast("long"), "turn", mark.alias("mark"), words.alias("words"))

    def number(batches):
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            begin = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            runs = np.diff(np.r_[begin, len(conv)])
            at = np.arange(1, len(conv) + 1) - np.repeat(begin, runs)
            if conv[0] == last:
                at[: runs[0]] += count
            last, count = conv[-1], at[-1]
            columns = [batch.column(0), pa.array(np.full(len(conv), part, np.int32)), pa.array(at), *batch.columns[1:]]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "at", "mark", "words"])

    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "mark", "words")
    local = stored(dealt.mapInArrow(number, "conv_id long, part int, at long, mark string, words long"), "turns")
    earlier = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    held = local.groupBy("conv_id", "part").agg(F.max("at").alias("n"))
    carried = held.select("conv_id", "part", F.sum("n").over(earlier).alias("before")).where("before > 0")
    pos = F.col("at") + F.coalesce("before", F.lit(0))
    return local.join(carried, ["conv_id", "part"], "left").select("conv_id", pos.alias("pos"), "mark", "words")


def spliced(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """``turns`` with the heads of other conversations, and (conv_id, length) of all, turnless ones too.

    Conversation c gets the first h turns of c - c % ``every`` instead of its own first h turns, h being
    the CRC-32 of its decimal number modulo ``most``.  With fewer turns there, all of them are taken.
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    heads = turns.where(f"conv_id % {every} = 0 and pos < {most}").withColumnRenamed("conv_id", "base")
    taken = convs.where(f"conv_id % {every} = 0").select(F.col("conv_id").alias("base"), F.col("n").alias("offered"))
    k = F.least("h", F.coalesce("offered", F.lit(0)))
    length = k + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    members = convs.withColumn("base", base).withColumn("h", h).join(taken, "base", "left")
    members = members.select("conv_id", "base", "h", length.alias("length"))
    lent = members.join(heads, "base").where("pos <= h").select("conv_id", "pos", "mark", "words")
    own = turns.withColumn("base", base).withColumn("h", h).where("pos > h").join(taken, "base", "left")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + k).alias("pos"), "mark", "words")
    return lent.unionByName(own), members.select("conv_id", "length")


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, node, parent, words): the hashes of the first ``pos`` and ``pos - 1`` turns.

    A prefix is named by two 64-bit lanes, each the exclusive or of the hashes of its numbered turns.  That
    is a scan that can be cut: chunks of a conversation are scanned alone and get the totals of those before.
    """
    turns = turns.withColumn("chunk", F.floor((F.col("pos") - 1) / CHUNK))
    lanes = {"a": F.xxhash64(F.lit(1), "pos", "mark"), "b": F.xxhash64(F.lit(2), "pos", "mark")}
    upto = W.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    within = turns.select("*", *[F.bit_xor(x).over(upto).alias(n) for n, x in lanes.items()])
    earlier = W.partitionBy("conv_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    sums = turns.groupBy("conv_id", "chunk").agg(*[F.bit_xor(x).alias(n) for n, x in lanes.items()])
    carried = sums.select("conv_id", "chunk", *[F.bit_xor(n).over(earlier).alias(f"{n}0") for n in lanes])
    rows = within.join(carried.where("chunk > 0"), ["conv_id", "chunk"], "left")
    whole = {n: F.col(n).bitwiseXOR(F.coalesce(f"{n}0", F.lit(0).cast("long"))) for n in lanes}
    node = F.struct(*[x.alias(n) for n, x in whole.items()])
    parent = F.struct(*[x.bitwiseXOR(lanes[n]).alias(n) for n, x in whole.items()])
    return rows.select("conv_id", "pos", node.alias("node"), parent.alias("parent"), "words")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of ends (node, conv_id): SHA-256 of the numbers, ascending and comma-joined.

    Numbers are sorted and joined in groups of at most 2 ** ID_BITS.  One hash is one chain, so the strings of
    a node are streamed through it in order; no node is held in memory.
    """
    group = F.shiftright("conv_id", ID_BITS)
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")), ",")
    parts = ends.groupBy("node", group.alias("part")).agg(ids.alias("ids"))
    parts = parts.repartition("node").sortWithinPartitions("node", "part")

    def digest(batches):
        key = state = None
        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (a, b) == key:
                    state.update(b"," + ids.encode())
                    continue
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (a, b), hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["a", "b", "ends_sha256"])
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, state.hexdigest())], names=["a", "b", "ends_sha256"])

    hashed = parts.select("node.a", "node.b", "ids").mapInArrow(digest, "a long, b long, ends_sha256 string")
    return hashed.select(F.struct("a", "b").alias("node"), "ends_sha256")


def _before(one: tuple[Column, Column], other: tuple[Column, Column], turn: int) -> Column:
    """Whether a node (depth, hash) goes before another one in round ``turn``: odd depths first.

    The root never goes, so it holds up nothing.  Ties of the lowest set bit are decided by a new draw.
    """
    order = []
    for depth, name in (one, other):
        low = F.when(depth == 0, F.lit(1 << 62)).otherwise(depth.bitwiseAND(-depth))
        order.append(F.struct(low.alias("low"), F.xxhash64(F.lit(turn), name).alias("draw")))
    return order[0] < order[1]


def subtree_sums(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """(node, one total for each column of ``sums``) of a tree (node, parent, depth, and the summed columns).

    ``node`` is a struct <a, b> of longs; the root alone has no parent and depth 0.  Rounds of joins contract
    the tree until its root is left.  A round rakes all leaves into their parents, and compresses chains: a
    node with one child that goes before its parent and its child (see _before) is removed, its child hangs on
    its parent from then on, with what the removed one held on its new edge.  Neighbours never go together.
    Every round leaves at most a fixed share of the nodes, however deep or wide the tree is.  A raked node's
    total is known at once; those of compressed nodes are filled in backwards from their child's.
    """
    kids = nodes.groupBy("parent").agg(F.count("*").alias("kids"), F.max("node.a").alias("kid"), F.max("depth").alias("kid_depth"))
    live = nodes.join(kids.withColumnRenamed("parent", "node"), "node", "left")
    live = live.select("node", "parent", "depth", (F.col("depth") - 1).alias("above"), "kid", "kid_depth", F.coalesce("kids", F.lit(0)).alias("kids"), *[F.col(c).cast("long").alias(c) for c in sums], *[F.lit(0).cast("long").alias(f"up_{c}") for c in sums])
    rounds = [live := stored(live, "live")]
    leaf = F.col("kids") == 0
    while live.where(~leaf).limit(1).count():
        turn = len(rounds)
        # leaves are raked: their totals go to the parent, which counts the children that stay
        met = live.groupBy("parent").agg(
            *[F.sum(F.when(leaf, F.col(c) + F.col(f"up_{c}"))).alias(f"in_{c}") for c in sums],
            F.count(F.when(~leaf, 1)).alias("kids"),
            F.max(F.when(~leaf, F.col("node.a"))).alias("kid"),
            F.max(F.when(~leaf, F.col("depth"))).alias("kid_depth"),
        )
        gained = [(F.col(c) + F.coalesce(f"in_{c}", F.lit(0))).alias(c) for c in sums]
        stay = live.where(~leaf).drop("kids", "kid", "kid_depth").join(met.withColumnRenamed("parent", "node"), "node")
        own = (F.col("depth"), F.col("node.a"))
        alone = (F.col("kids") == 1) & (F.col("depth") > 0)
        first = _before(own, (F.col("above"), F.col("parent.a")), turn) & _before(own, (F.col("kid_depth"), F.col("kid")), turn)
        stay = stay.select("node", "parent", "depth", "above", "kid", "kid_depth", "kids", *gained, *[f"up_{c}" for c in sums])
        stay = stored(stay.withColumn("goes", alone & first), "raked")
        # chains are compressed: the child of a node that goes takes its parent, and its sums on the edge
        gone = stay.where("goes").select(F.col("node").alias("parent"), F.col("parent").alias("over"), F.col("above").alias("over_depth"), *[F.col(c).alias(f"g_{c}") for c in sums], *[F.col(f"up_{c}").alias(f"g_up_{c}") for c in sums])
        stay = stay.where("not goes").join(gone, "parent", "left")
        lost = F.col("over").isNotNull()
        live = stay.select(
            "node", F.when(lost, F.col("over")).otherwise(F.col("parent")).alias("parent"), "depth",
            F.when(lost, F.col("over_depth")).otherwise(F.col("above")).alias("above"), "kid", "kid_depth", "kids", *sums,
            *[F.when(lost, F.col(f"up_{c}") + F.col(f"g_{c}") + F.col(f"g_up_{c}")).otherwise(F.col(f"up_{c}")).alias(f"up_{c}") for c in sums],
            F.when(lost, F.col("parent")).alias("gone"), *[(F.col(f"g_{c}") + F.col(f"up_{c}")).alias(f"gone_{c}") for c in sums],
        )
        rounds.append(live := stored(live, "live"))
    known = None
    for turn in range(len(rounds) - 1, -1, -1):
        raked = rounds[turn].where(leaf).select("node", *sums)
        known = raked if known is None else known.unionByName(raked)
        if "gone" in rounds[turn].columns and rounds[turn].where("gone is not null").limit(1).count():
            gone = rounds[turn].where("gone is not null").select("node", "gone", *[f"gone_{c}" for c in sums])
            filled = gone.join(known, "node").select(F.col("gone").alias("node"), *[(F.col(c) + F.col(f"gone_{c}")).alias(c) for c in sums])
            known = known.unionByName(stored(filled, "filled"))
    return known


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the prefix tree of ``members`` (conv_id, length) with ``turns`` (conv_id, pos, mark, words).

    A node is a distinct sequence of first turns; all conversations that start with it are its members, the
    root has all.  One row per node, all long but the hash: conv_id (smallest member), depth, parent_conv_id
    (null for the root), n_convs, n_children, n_leaves, saved_tokens (words that its subtree need not hold
    again) and ends_sha256 (hash of the members that end there).  No conversations give no rows.
    """
    prefixes = stored(_prefixes(turns), "prefixes")
    count, least = F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")
    nodes = prefixes.groupBy("node", F.col("pos").alias("depth")).agg(least, count, F.max("words").alias("words"), F.max("parent.a").alias("a"), F.max("parent.b").alias("b"))
    nodes = nodes.withColumn("parent", F.struct("a", "b")).drop("a", "b")
    root = members.agg(least, count).where("n_convs > 0").withColumns({"node": _root(), "depth": F.lit(0).cast("long"), "words": F.lit(0).cast("long")})
    nodes = stored(nodes.unionByName(root, allowMissingColumns=True), "nodes")
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")})
    nodes = stored(nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")), "nodes")
    totals = subtree_sums(nodes.select("node", "parent", "depth", "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"])
    last = members.where("length > 0").join(prefixes.withColumnRenamed("pos", "length"), ["conv_id", "length"]).select("node", "conv_id")
    ended = _end_hashes(last.unionByName(members.where("length = 0").select(_root().alias("node"), "conv_id")))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.drop("n_leaves", "saved_tokens", "words").join(totals, "node").join(ended, "node", "left").join(above, "parent", "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix tree of ``conversations`` (conv_id, turn, role, text) after spliced(); other columns are ignored."""
    return prefix_trie(*spliced(stored(ordered_turns(conversations), "ordered")))


#: The same rows from whole prefixes: every node meets all its descendants.
TRIE_SQL = r"""
WITH RECURSIVE own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT conv_id, max(pos) AS n, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
           lambda crc, x: list_reduce(list_prepend(xor(crc, x), range(8)), lambda v, i: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 4 AS h
  FROM own GROUP BY conv_id
), sized AS (
  SELECT c.conv_id, c.n, c.h, least(c.h, coalesce(b.n, 0)) AS k FROM conv c LEFT JOIN conv b ON b.conv_id = c.conv_id - c.conv_id % 20
), built AS (
  SELECT s.conv_id, o.pos, o.role, o.text FROM sized s JOIN own o ON o.conv_id = s.conv_id - s.conv_id % 20 AND o.pos <= s.h
  UNION ALL
  SELECT s.conv_id, o.pos - s.h + s.k, o.role, o.text FROM sized s JOIN own o ON o.conv_id = s.conv_id AND o.pos > s.h
), walked AS (
  SELECT conv_id, 0::bigint AS depth, 'root' AS node, NULL::varchar AS parent, 0::bigint AS words FROM sized
  UNION ALL
  SELECT w.conv_id, w.depth + 1, sha256(w.node || length(b.role)::varchar || ':' || b.role || b.text), w.node, len(regexp_extract_all(b.text, '[^\x20\x09-\x0D]+'))::bigint
  FROM walked w JOIN built b ON b.conv_id = w.conv_id AND b.pos = w.depth + 1
), ending AS (
  SELECT node, string_agg(conv_id::varchar, ',' ORDER BY conv_id) AS ids
  FROM (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS last FROM walked) WHERE depth = last GROUP BY node
), nodes AS (
  SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, count(*) AS n_convs, any_value(words) AS words
  FROM walked GROUP BY node
), kids AS (
  SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), valued AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children, (n.n_convs - 1) * n.words AS saved FROM nodes n LEFT JOIN kids k USING (node)
), lines AS (
  SELECT node AS top, node, parent, n_children, saved FROM valued
  UNION ALL
  SELECT v.parent, l.node, v.parent, l.n_children, l.saved FROM lines l JOIN valued v ON v.node = l.top WHERE v.parent IS NOT NULL
), totals AS (
  SELECT top AS node, sum((n_children = 0)::int)::bigint AS n_leaves, sum(saved)::bigint AS saved_tokens FROM lines GROUP BY top
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, t.n_leaves, t.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM valued v JOIN totals t USING (node) LEFT JOIN ending e USING (node) LEFT JOIN nodes p ON p.node = v.parent
"""
