"""Mixing sources to target weights by a token budget that is handed down a tree.

The tree has a level for each grouping column, from domain to language to source.  A node's budget is shared
among its children by weight.  A child gets no more than it can give (its tokens, times the epochs that are
allowed); what it leaves over goes to its siblings by weight.  Since a node counts with all that its subtree can
give, a shortage leaves a node only when none of its children can fill it.

A leaf is read in seeded epochs: whole ones as long as the budget allows, then a prefix of the next.  An epoch's
order is a hash of seed, epoch, doc_id and text.  The prefix ends at a key that is found digit by digit from sums
over hashed groups, so no leaf is ever sorted as a whole.  Everything is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import stored

#: Hex digits of the order key that are fixed in each step.
STEPS = (2, 4, 6)
#: Leaves up to which the plan is broadcast; beyond, it is joined by shuffling.
FEW_LEAVES = 100_000
#: Stands for a null in a grouping column.
NONE = "(none)"
WHOLE = "decimal(38,0)"


def word_tokens(text: str = "text") -> Column:
    """Words of a text, at white space of ASCII; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_key(seed: int, epoch: Column, doc_id: Column, text_hash: Column) -> Column:
    parts = [F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")), text_hash]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def text_hash(text: str = "text") -> Column:
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def weight_of(names: Mapping[str, int], column: str) -> Column:
    """The weight of a node by its name; 1 for names that have none."""
    found = F.lit(1)
    for name, weight in names.items():
        found = F.when(F.col(column) == name, weight).otherwise(found)
    return found.cast("long")


def share(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """``nodes`` (parent columns, name, cap, weight, budget of the parent) with their own ``budget``.

    Children in the order of what they can give for their weight: those that give all come first.  What they
    leave is shared by weight, rounded down.  A child with a weight of 0 or less gets nothing.
    """
    order = W.partitionBy(*parent).orderBy(F.col("cap").cast("double") / F.col("weight"), name)
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    family = W.partitionBy(*parent)
    zero = F.lit(0).cast(WHOLE)
    counted = nodes.where("weight > 0").withColumns(
        {
            "given": F.coalesce(F.sum(F.col("cap").cast(WHOLE)).over(before), zero).cast(WHOLE),
            "open": F.sum(F.col("weight").cast(WHOLE)).over(after).cast(WHOLE),
        }
    )
    gives_all = F.expr(f"cast(cap as {WHOLE}) * open <= (cast(budget as {WHOLE}) - given) * weight")
    marked = counted.withColumn("gives_all", gives_all)
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("gives_all"), F.col("cap"))).over(family), F.lit(0))
    takers = F.sum(F.when(~F.col("gives_all"), F.col("weight"))).over(family)
    shared = marked.withColumns({"rest": rest.cast(WHOLE), "takers": takers.cast(WHOLE)})
    own = F.when(F.col("gives_all"), F.col("cap")).otherwise(F.expr("(rest * weight) div takers")).cast("long")
    return shared.select(*parent, name, own.alias("budget"))


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], budget: int, epochs: int) -> DataFrame:
    """(levels, tokens, budget) of each leaf of ``leaves`` (levels, tokens)."""
    given = None
    for depth, name in enumerate(levels):
        parent = list(levels[:depth])
        nodes = leaves.groupBy(*parent, name).agg((F.sum("tokens") * epochs).cast("long").alias("cap"))
        nodes = nodes.withColumn("weight", weight_of(weights.get(name, {}), name))
        if given is None:
            nodes = nodes.withColumn("budget", F.lit(budget).cast("long"))
        else:
            nodes = nodes.join(given, parent)
        given = share(nodes, parent, name)
    return leaves.join(given, list(levels), "left").withColumn("budget", F.coalesce("budget", F.lit(0)).cast("long"))


def _near(frame: DataFrame, leaves: DataFrame, levels: Sequence[str], few: bool) -> DataFrame:
    return frame.join(F.broadcast(leaves) if few else leaves, list(levels))


def plan(sizes: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], budget: int, epochs: int, seed: int) -> tuple[DataFrame, bool]:
    """What to read of each leaf: (levels, whole epochs, cut), and whether the plan may be broadcast.

    ``sizes`` has (levels, doc_id, text_hash, tokens) of every document.  Of epoch number ``whole`` the documents
    with keys up to ``cut`` are read; none if it is null.
    """
    leaves = stored(sizes.groupBy(*levels).agg(F.sum("tokens").alias("tokens")), "leaves")
    few = leaves.count() <= FEW_LEAVES
    each = budgets(leaves, levels, weights, budget, epochs).where("tokens > 0")
    whole = F.least(F.expr("budget div tokens"), F.lit(epochs)).cast("int")
    each = each.withColumn("whole", whole).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    each = stored(each.select(*levels, "whole", F.when(F.col("whole") < epochs, F.col("rest")).otherwise(0).alias("rest"), F.lit("").alias("cut")), "plan")
    key = order_key(seed, F.col("whole"), F.col("doc_id"), F.col("text_hash"))
    last = STEPS[-1] + 1
    for digits in (*STEPS, last):
        step = F.col("key") if digits == last else F.substring("key", 1, digits)
        keyed = _near(sizes, each.where("rest > 0"), levels, few).withColumn("key", key)
        sums = keyed.where("startswith(key, cut)").groupBy(*levels, "cut", "rest", step.alias("step")).agg(F.sum("tokens").alias("tokens"))
        order = W.partitionBy(*levels).orderBy("step").rowsBetween(W.unboundedPreceding, W.currentRow)
        run = sums.withColumn("upto", F.sum("tokens").over(order))
        if digits == last:
            fits = run.where("upto <= rest").groupBy(*levels).agg(F.max("step").alias("end"))
            each = each.join(fits, list(levels), "left").withColumn("cut", F.coalesce("end", "cut")).drop("end")
            break
        # the first group that does not fit as a whole holds the end
        over = run.where("upto > rest").groupBy(*levels).agg(F.min_by(F.struct("step", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left")), "step").alias("at"))
        each = each.join(over, list(levels), "left")
        each = each.select(*levels, "whole", F.coalesce("at.left", "rest").alias("rest"), F.coalesce("at.step", "cut").alias("cut"))
        each = stored(each, "plan")
    return stored(each.select(*levels, "whole", F.when(F.col("rest") >= 0, F.col("cut")).alias("cut")), "plan"), few


def chosen(rows: DataFrame, leaves: DataFrame, few: bool, levels: Sequence[str], seed: int) -> DataFrame:
    """``rows`` (levels, doc_id, text_hash, ...) once for each epoch that reads them, with its number ``epoch``."""
    met = _near(rows, leaves, levels, few)
    key = order_key(seed, F.col("whole"), F.col("doc_id"), F.col("text_hash"))
    partly = F.coalesce((F.col("cut") != "") & (key <= F.col("cut")), F.lit(False))
    times = F.col("whole") + partly.cast("int")
    reads = F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))
    return met.withColumn("epoch", F.explode(reads)).drop("whole", "cut")


def source_domain(source: str = "source") -> Column:
    """The domain of a source by the number that its name ends in; ``other`` without one."""
    number = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), "([0-9]+)$", 1)
    named = F.element_at(F.array(*map(F.lit, ("web", "books", "code"))), (F.try_to_number(number, F.lit("9" * 18)) % 3 + 1).cast("int"))
    return F.when(number != "", named).otherwise("other")


LEVELS = ("domain", "lang", "source")
#: Weights by name at each level; names that are not listed weigh 1.
WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 6, "de": 2}}
SEED = 17


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, domain, lang, source, tokens, text_hash) of every row; null names count as one of their own."""
    named = [F.coalesce(c, F.lit(NONE)).alias(c) for c in ("lang", "source")]
    return docs.select(F.col("doc_id").cast("long"), source_domain().alias("domain"), *named, word_tokens().alias("tokens"), text_hash().alias("text_hash"))


def mixture(docs: DataFrame, percent: int = 100, epochs: int = 2, seed: int = SEED, weights: Mapping[str, Mapping[str, int]] = WEIGHTS) -> DataFrame:
    """(doc_id, domain, lang, source, tokens, epoch) of what a mix of ``percent`` of all tokens reads.

    Reads ``docs`` (doc_id, text, lang, source); other columns are ignored.  Rows that are equal in doc_id and
    text are taken together.  Texts without words weigh nothing: they come with whole epochs, and with a prefix
    as their keys fall.  A leaf without any tokens is not read.
    """
    sizes = stored(sized(docs), "sizes")
    total = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    leaves, few = plan(sizes, LEVELS, weights, total * percent // 100, epochs, seed)
    return chosen(sizes, leaves, few, LEVELS, seed).select("doc_id", *LEVELS, "tokens", "epoch")


def keep_mixed(docs: DataFrame, percent: int, seed: int = SEED, weights: Mapping[str, Mapping[str, int]] = WEIGHTS) -> DataFrame:
    """The rows of ``docs`` that a mix of ``percent`` of all tokens reads in one epoch, all columns as they are.

    Texts are not shuffled: the small plan comes to the rows.
    """
    sizes = stored(sized(docs), "sizes")
    total = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    leaves, few = plan(sizes, LEVELS, weights, total * percent // 100, 1, seed)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    named = [F.coalesce(c, F.lit(NONE)).alias(c) for c in ("lang", "source")]
    rows = docs.select(row, F.col("doc_id").cast("long"), source_domain().alias("domain"), *named, text_hash().alias("text_hash"))
    read = chosen(rows, leaves, few, LEVELS, seed)
    return read.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _share_sql(source: str, parent: str, name: str, weight: str) -> str:
    keys, part = (f"{parent}, {name}", f"PARTITION BY {parent}") if parent else (name, "")
    return f"""
    SELECT {keys}, CAST(CASE WHEN gives_all THEN cap ELSE
        ((budget - coalesce(sum(CASE WHEN gives_all THEN cap END) OVER ({part}), 0)) * weight)
        // (sum(CASE WHEN NOT gives_all THEN weight END) OVER ({part})) END AS BIGINT) AS budget
    FROM (SELECT *, cap * open <= (budget - given) * weight AS gives_all FROM (
        SELECT *, coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
               sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
        FROM (SELECT *, {weight} AS weight FROM ({source}))
        WINDOW w AS ({part} ORDER BY CAST(cap AS DOUBLE) / weight, {name})))"""


def mixture_sql(percent: int = 100, epochs: int = 2, seed: int = SEED) -> str:
    """The rows of ``mixture`` over ``documents`` with the weights above, in DuckDB."""
    leaf = "domain, lang, source"
    node = lambda keys, given: f"SELECT {keys}, n.cap, g.budget FROM (SELECT {keys}, sum(cap) AS cap FROM leaves GROUP BY ALL) n JOIN {given}"
    domain = _share_sql(f"SELECT domain, sum(cap) AS cap, any_value(budget) AS budget FROM leaves, goal GROUP BY domain", "", "domain", "CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'code' THEN 2 ELSE 1 END")
    lang = _share_sql(node("domain, lang", "by_domain g USING (domain)"), "domain", "lang", "CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 ELSE 1 END")
    source = _share_sql(node(leaf, "by_lang g USING (domain, lang)"), "domain, lang", "source", "1")
    return f"""
    WITH sizes AS (
        SELECT doc_id, coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens, md5(coalesce(text, '')) AS text_hash,
               CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '' THEN 'other' ELSE
                   ['web', 'books', 'code'][CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 3 + 1] END AS domain
        FROM documents),
    goal AS (SELECT CAST(sum(tokens) * {percent} // 100 AS BIGINT) AS budget FROM sizes),
    leaves AS (SELECT {leaf}, sum(tokens) AS tokens, sum(tokens) * {epochs} AS cap FROM sizes GROUP BY ALL),
    by_domain AS ({domain}), by_lang AS ({lang}), by_source AS ({source}),
    plan AS (
        SELECT {leaf}, tokens AS held, least(budget // tokens, {epochs}) AS whole, budget - least(budget // tokens, {epochs}) * tokens AS rest
        FROM leaves JOIN by_source USING ({leaf}) WHERE tokens > 0),
    keyed AS (
        SELECT s.*, whole, rest, md5(concat_ws(':', '{seed}', CAST(whole AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), ''), text_hash)) AS key
        FROM sizes s JOIN plan USING ({leaf})),
    run AS (
        SELECT *, sum(tokens) OVER (PARTITION BY {leaf} ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM keyed)
    SELECT doc_id, {leaf}, tokens, CAST(unnest(range(CAST(whole + CASE WHEN whole < {epochs} AND rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT))) AS INTEGER) AS epoch
    FROM run"""
