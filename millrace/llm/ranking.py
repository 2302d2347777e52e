"""Ranked lexical search: terms rarest first, with a limit on the accumulators that are begun."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import slices, stored

#: Documents that an item gets.
TOP = 50
#: Different terms of the items of one block, about: what workers hold of the items at a time.
BLOCK_TERMS = 100_000
#: Documents, and postings, of one piece of the index.
PIECE_DOCS = 1 << 14
PIECE_POSTINGS = 1 << 21

#: Bytes between terms are blanks, A-Z is lower-cased: the terms of a text are then what stands between blanks.
_FOLD = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text with repeats: runs of ASCII letters, digits and characters above ASCII."""
    return (text or "").encode().translate(_FOLD).split()


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term) of ``items`` (item_id, text), once each; rows that share an id are one item."""

    def read(batches):
        for batch in slices(batches, "text"):
            rows = [(item, term) for item, text in zip(*(batch.column(i).to_pylist() for i in (0, 1))) for term in set(terms_of(text))]
            if rows:
                ids, terms = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], names=["item_id", "term"])

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(read, "item_id long, term binary").distinct()


def _index(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document: how many terms it has, and which of the vocabulary how often.

    Terms are numbers, ascending; a document without any of them has empty lists.
    """
    numbers = pa.list_(pa.int32())
    fields = [pa.field("doc_id", pa.int64()), pa.field("n", pa.int64()), pa.field("terms", numbers), pa.field("tfs", numbers)]
    known = docs.sparkSession.sparkContext.broadcast(b" ".join(vocabulary))

    def read(batches):
        number = {term: i for i, term in enumerate(known.value.split())}
        for batch in slices(batches, "text"):
            ns, terms, tfs = [], [], []
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                held = sorted((number[w], tf) for w, tf in Counter(words).items() if w in number)
                ns.append(len(words))
                terms.append([t for t, _ in held])
                tfs.append([tf for _, tf in held])
            lists = [pa.array(c, f.type) for c, f in zip((ns, terms, tfs), fields[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], schema=pa.schema(fields))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, "doc_id long, n long, terms array<int>, tfs array<int>")


def rank_piece(offsets, posted, gains, queries, top: int = TOP):
    """The ``top`` best documents of one piece of the index for every query: rows (query, document, score).

    ``posted[offsets[t]:offsets[t + 1]]`` are the documents that hold term t, and ``gains`` what each adds to a
    score.  ``queries`` lists the terms of each, rarest first.  Term by term, documents get accumulators, until
    the greatest gains of the terms that are left add up to less than the ``top``-th partial score: no new
    document could be among the best.  From then on only documents that have one are updated, by all terms
    that are left, so their scores are exact.  Documents are numbered in the order that decides between equal
    scores.
    """
    n_docs = int(posted.max(initial=-1)) + 1
    most = np.zeros(len(offsets) - 1, np.int64)
    filled = np.flatnonzero(np.diff(offsets))
    most[filled] = np.maximum.reduceat(gains, offsets[filled]) if len(filled) else 0
    score, begun = np.zeros(n_docs, np.int64), np.zeros(n_docs, bool)
    found = []
    for q, terms in enumerate(queries):
        left = np.append(np.cumsum(most[terms][::-1])[::-1], 0)
        score[:], begun[:] = 0, False
        n_begun, open_, since = 0, True, 0
        for k, t in enumerate(terms):
            docs, gain = posted[offsets[t] : offsets[t + 1]], gains[offsets[t] : offsets[t + 1]]
            if not open_:
                held = begun[docs]
                score[docs[held]] += gain[held]
                continue
            score[docs] += gain
            fresh = docs[~begun[docs]]
            begun[fresh] = True
            n_begun, since = n_begun + len(fresh), since + len(docs)
            # the least partial score among the best is looked for when enough has changed to be worth it
            if n_begun >= top and (since >= n_begun // 4 or k + 1 == len(terms)):
                since = 0
                partial = score[begun]
                open_ = left[k + 1] >= np.partition(partial, len(partial) - top)[len(partial) - top]
        at = np.flatnonzero(score > 0)
        if len(at) > top:
            least = np.partition(score[at], len(at) - top)[len(at) - top]
            above, equal = at[score[at] > least], at[score[at] == least]
            at = np.append(above, equal[: top - len(above)])
        found.append((np.full(len(at), q), at, score[at].copy()))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3


def _pieces(batches):
    """Rows of the index in pieces of bounded size, as (doc_ids with nulls, n, lengths, terms, tfs)."""
    held, docs, postings = [], 0, 0
    for batch in batches:
        held.append(batch)
        docs, postings = docs + len(batch), postings + len(batch.column(2).flatten())
        if docs >= PIECE_DOCS or postings >= PIECE_POSTINGS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, docs, postings = [], 0, 0
    if docs:
        yield pa.Table.from_batches(held).combine_chunks()


def _best(index: DataFrame, items: list[tuple[int | None, list[int]]], weights: list[int], n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item_id, doc_id, score): the best documents of each piece of the index for every item."""
    spark = index.sparkSession
    names = ["item_id", "doc_id", "score"]
    queries = spark.sparkContext.broadcast(([i for i, _ in items], [np.array(t, np.int64) for _, t in items], np.array(weights, np.int64)))

    def rank(batches):
        ids, wanted, w = queries.value
        for piece in _pieces(batches):
            rows = piece.to_batches()[0]
            keys = rows.column(0)
            order = pa.compute.sort_indices(keys, null_placement="at_start")
            keys, rows = keys.take(order), rows.take(order)
            n = rows.column(1).to_numpy()
            lengths = np.diff(rows.column(2).offsets.to_numpy())
            term, tf = (rows.column(i).flatten().to_numpy().astype(np.int64) for i in (2, 3))
            doc = np.repeat(np.arange(len(n)), lengths)
            m = 100 - 50 + (50 * n * n_docs) // max(n_terms, 1)
            gain = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
            sort = np.argsort(term, kind="stable")
            offsets = np.searchsorted(term[sort], np.arange(len(w) + 1))
            q, at, score = rank_piece(offsets, doc[sort], gain[sort], wanted, top)
            item = pa.array([ids[i] for i in q], pa.int64())
            yield pa.RecordBatch.from_arrays([item, keys.take(pa.array(at)), pa.array(score)], names=names)

    return index.mapInArrow(rank, "item_id long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best rows of ``docs`` (doc_id, text) for each of ``items`` (item_id, text).

    With N documents that have terms, L terms in all, n terms in a document and tf, df of a term, it adds
    w * (10**9 * tf // (1000 * tf + 20 * m)) to the score, w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))) and
    m = 100 - 50 + 50 * n * N // L; all but the logarithm in 64-bit integers.  Scores of 0 are left out, equal ones are
    ordered by doc_id, null first.  Items are dealt into blocks of bounded vocabulary; for each, the documents
    are read once into an index of its terms, which is searched piece by piece where it lies: only the best of
    each piece are shuffled.  Null texts have no terms; rows of ``docs`` that share an id are ranked
    each for itself, rows of ``items`` that share one are one item with the terms of all.  Empty tables and
    items without terms give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    pairs = stored(_item_terms(items), "terms")
    blocks = max(1, -(-pairs.count() // BLOCK_TERMS))
    found = None
    for block in range(blocks):
        wanted = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        vocabulary = sorted(bytes(r.term) for r in wanted.select("term").distinct().collect())
        if not vocabulary:
            continue
        index = stored(_index(docs, vocabulary), "index")  # its postings never move
        totals = index.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = dict(index.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weights = [math.floor(1000 * math.log((2 * totals.docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))]
        number = {term: t for t, term in enumerate(vocabulary)}
        terms: dict[int | None, list[int]] = {}
        for item_id, term in wanted.collect():
            terms.setdefault(item_id, []).append(number[bytes(term)])
        listed = [(i, sorted(ts, key=lambda t: (df.get(t, 0), t))) for i, ts in terms.items()]
        best = _best(index, listed, weights, totals.docs, totals.terms, top)
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    place = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


#: The same ranking from all pairs of an item and a document that share a term.
RANKING_SQL = r"""
WITH words AS (
  SELECT doc_row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS doc_row, doc_id, text FROM documents)
), tf AS (SELECT doc_row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM words GROUP BY doc_row, term),
sized AS (SELECT doc_row, sum(tf)::bigint AS n FROM tf GROUP BY doc_row),
totals AS (SELECT count(*) AS docs, sum(n)::bigint AS terms FROM sized),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weighed AS (SELECT term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)))::bigint AS w FROM df, totals),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_row, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // terms)))))::bigint AS score
  FROM wanted JOIN weighed USING (term) JOIN tf USING (term) JOIN sized USING (doc_row), totals GROUP BY item_id, doc_row
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::int AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""
