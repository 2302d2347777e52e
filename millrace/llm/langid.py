"""Language identification: word frequencies first, character n-grams for words that are not known."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, stored

#: Bytes of the scores that travel to the workers: those of the most frequent words of all training text, as
#: many as fit.  Rarer words are scored by joins with the whole tables.
MAX_BYTES = 16 << 20
#: Bytes of the scores of the n-grams of one length up to which these are sent to the words.
MAX_BROADCAST = 32 << 20
#: Longest n-gram tried for an unseen word; then one shorter, and so on.
LONGEST = 4
#: Added to every count.
PRIOR = 0.5
NOT_A_LANGUAGE = "und"


def words_of(text: str = "text") -> F.Column:
    """Lower-cased runs of letters."""
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"\p{L}+"), F.lit(0))


def _frequent(counts: DataFrame, key: str, most: int) -> DataFrame:
    """The rows of the keys with the highest totals, at most ``most`` keys; ties at the edge are left out."""
    totals = counts.groupBy(key).agg(F.sum("n").alias("total"))
    bars = totals.groupBy("total").count().orderBy(F.desc("total"))
    least, held = 1, 0
    for row in bars.toLocalIterator():
        held += row["count"]
        if held > most:
            least = row.total + 1
            break
    return counts.join(totals.where(F.col("total") >= least).select(key), key)


def _table(counts: DataFrame, key: str, langs: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The different keys, and the count of each in every language; both stay in Arrow or numpy."""
    rows = counts.select(key, "lang", "n").toArrow().combine_chunks()
    if not len(rows):
        return pa.array([], pa.string()), np.zeros((0, len(langs)))
    coded = rows.column(key).chunk(0).dictionary_encode()
    lang = pc.index_in(rows.column("lang").chunk(0), value_set=pa.array(langs, pa.string()))
    table = np.zeros((len(coded.dictionary), len(langs)))
    np.add.at(table, (coded.indices.to_numpy(), lang.to_numpy()), rows.column("n").chunk(0).to_numpy())
    return coded.dictionary.cast(pa.string()), table


class Counts(NamedTuple):
    """All words and n-grams of the training text, as tables that stay in the cluster."""

    langs: list[str]
    words: DataFrame  # lang, word, n
    grams: DataFrame  # lang, gram, n
    sizes: list[int]  # words of each language
    different: int  # words
    gram_sizes: dict[int, list[int]]  # n: n-grams of each language
    gram_different: dict[int, int]


def _grams_of(framed: str, orders: range) -> F.Column:
    """All n-grams of a column, repeats included, for each n of ``orders``."""
    each = [f"transform(sequence(1, length({framed}) - {n - 1}), i -> substring({framed}, i, {n}))" for n in orders]
    return F.flatten(F.array(*[F.when(F.length(framed) >= n, F.expr(x)).otherwise(F.array()) for n, x in zip(orders, each)]))


def _framed() -> F.Column:
    return F.concat(F.lit("^"), F.col("word"), F.lit("$")).alias("framed")


def count(train: DataFrame) -> Counts:
    """Count words and n-grams of every row of ``train`` (text, lang); rows where either is null are left out."""
    words = train.where("text is not null and lang is not null").select("lang", F.explode(words_of()).alias("word"))
    counts = stored(words.groupBy("lang", "word").agg(F.count("*").alias("n")), "words")
    size = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(size)
    pieces = counts.select("lang", "n", _framed()).select("lang", "n", F.explode(_grams_of("framed", range(1, LONGEST + 1))).alias("gram"))
    grams = stored(pieces.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    length = F.length("gram").alias("length")
    total = {(r.length, r.lang): r.n for r in grams.groupBy(length, "lang").agg(F.sum("n").alias("n")).collect()}
    different = {r.length: r["count"] for r in grams.select("gram").distinct().groupBy(length).count().collect()}
    orders = range(1, LONGEST + 1)
    return Counts(
        langs, counts, grams, [size[x] for x in langs], counts.select("word").distinct().count(),
        {n: [total.get((n, x), 0) for x in langs] for n in orders}, {n: different.get(n, 0) for n in orders},
    )


def frequent_words(counts: Counts) -> tuple[pa.Array, np.ndarray]:
    """The words that go to the driver and the workers, and the log frequencies of each in every language."""
    row = 8 * len(counts.langs) + 32
    keys, table = _table(_frequent(counts.words, "word", MAX_BYTES // row), "word", counts.langs)
    return keys, np.log((table + PRIOR) / (np.array(counts.sizes, float) + PRIOR * (counts.different + 1)))


def _by_language(counts: Counts, key: str, rows: DataFrame) -> DataFrame:
    """(key, n0, n1, ...): the counts of each key in each language."""
    return rows.groupBy(key).agg(*[F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{i}") for i, x in enumerate(counts.langs)])


def further_scores(counts: Counts, words: DataFrame) -> DataFrame:
    """(word, s0, s1, ...) of each of ``words`` (word, different ones), from the whole tables.

    A word of the training text has its log frequencies.  Another has the mean of its longest n-grams of which
    the training text has any, and no row if it has none: all words meet the longest n-grams, and only those
    that are left go on to the next shorter ones.
    """
    every = range(len(counts.langs))
    seen = _by_language(counts, "word", counts.words.join(words, "word"))
    log = lambda i, size, different: F.log((F.col(f"n{i}") + PRIOR) / F.lit(size + PRIOR * (different + 1)))
    seen = stored(seen.select("word", *[log(i, counts.sizes[i], counts.different).alias(f"s{i}") for i in every]), "seen")
    left = stored(words.join(seen.select("word"), "word", "left_anti").select("word", _framed()), "unseen")
    found = seen
    for n in range(LONGEST, 0, -1):
        pieces = left.select("word", F.explode(_grams_of("framed", range(n, n + 1))).alias("gram"))
        grams = _by_language(counts, "gram", counts.grams.where(F.length("gram") == n))
        grams = stored(grams.select("gram", *[log(i, counts.gram_sizes[n][i], counts.gram_different[n]).alias(f"s{i}") for i in every]), "gram_scores")
        # a small table goes to the words, and their n-grams stay where they are; beyond that both are shuffled
        few = counts.gram_different[n] * (8 * len(counts.langs) + 32) <= MAX_BROADCAST
        met = pieces.join(F.broadcast(grams) if few else grams, "gram").groupBy("word").agg(*[F.avg(f"s{i}").alias(f"s{i}") for i in every])
        found = found.unionByName(met := stored(met, "met"))
        left, before = stored(left.join(met, "word", "left_anti"), "unseen"), left
        discard(grams, before)
    return found


def predict(docs: DataFrame, counts: Counts) -> DataFrame:
    """``lang_pred`` and ``score`` for each row of ``docs`` (doc_id, held_out, text); other columns are ignored.

    The score is the probability of the predicted language, equal priors.  Text that is null or without letters,
    or a training text without any, gives ``und`` and 0.  Workers score the most frequent words; all others
    meet the whole tables in joins, so what the workers hold does not change the result.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "held_out", words_of().alias("words"))
    if not counts.langs:
        return rows.select("doc_id", "held_out", F.lit(NOT_A_LANGUAGE).alias("lang_pred"), F.lit(0.0).alias("score"))
    # plain arrays: workers need not have this package
    sent = docs.sparkSession.sparkContext.broadcast(frequent_words(counts))
    n_langs = len(counts.langs)
    every = range(n_langs)

    def run(batches):
        known, scores_of = sent.value
        for batch in batches:
            for at in range(0, len(batch), 1000):
                piece = batch.slice(at, 1000)
                flat = piece.column(3).flatten().dictionary_encode()
                lengths = pc.list_value_length(piece.column(3)).fill_null(0).to_numpy(zero_copy_only=False)
                place = pc.index_in(flat.dictionary, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
                table = np.concatenate([scores_of, np.zeros((1, n_langs))])[place]
                tokens = flat.indices.to_numpy()
                sums, full, starts = np.zeros((len(piece), n_langs)), np.flatnonzero(lengths), np.cumsum(lengths) - lengths
                if len(full):
                    sums[full] = np.add.reduceat(table[tokens], starts[full], axis=0)
                rare = place[tokens] < 0 if len(tokens) else np.empty(0, bool)
                before = np.concatenate([[0], np.cumsum(rare)])
                offsets = np.append(before[starts], before[-1]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), flat.dictionary.take(pa.array(tokens[rare])))
                columns = [*(piece.column(k) for k in range(3)), pa.array(lengths.astype(np.int64)), pa.array(list(sums), pa.list_(pa.float64())), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "held_out", "n", "sums", "rare"])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "*")
    parts = stored(numbered.mapInArrow(run, "row long, doc_id long, held_out boolean, n long, sums array<double>, rare array<string>"), "sums")
    asked = parts.select("row", F.explode("rare").alias("word"))
    scores = stored(further_scores(counts, stored(asked.select("word").distinct(), "further")), "further_scores")
    more = asked.join(scores, "word").groupBy("row").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in every])
    total = F.array(*[F.col("sums")[i] + F.coalesce(f"s{i}", F.lit(0.0)) for i in every])
    met = parts.join(more, "row", "left").select("doc_id", "held_out", "n", total.alias("total"))
    most = met.withColumn("most", F.array_max("total"))
    name = F.element_at(F.array(*map(F.lit, counts.langs)), F.array_position("total", F.col("most")).cast("int"))
    chance = 1 / F.aggregate("total", F.lit(0.0), lambda sum_, x: sum_ + F.exp(x - F.col("most")))
    some = F.col("n") > 0
    return most.select("doc_id", "held_out", F.when(some, name).otherwise(NOT_A_LANGUAGE).alias("lang_pred"), F.when(some, chance).otherwise(0.0).alias("score"))


def identify(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Learn from all labelled rows outside the held-out fold, then predict every row.

    Fold: crc32 of doc_id as text.  A null doc_id is not held out and not learned from.  Rows that repeat
    are counted and answered each for itself.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    marked = docs.select("doc_id", "text", "lang", F.coalesce(fold == held, F.lit(False)).alias("held_out"))
    return predict(marked, count(marked.where(~F.col("held_out") & F.col("doc_id").isNotNull())))
