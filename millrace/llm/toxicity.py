"""Toxicity of texts: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters the network as two vectors: one of the word itself, if training has seen it often enough, and
the mean of its character trigrams (on UTF-8 bytes, with its ends marked).  A window of words is read in both
directions, its states are pooled by attention, and a text has the score of its worst window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each class that the network is fitted on, all their words.
TRAIN_ROWS = 1600
#: Words of a window, and words from one window to the next.
WINDOW, STEP = 48, 36
#: Known words, trigram buckets, sizes of the vectors and of the state of a direction.
VOCABULARY, BUCKETS, WIDTH, STATE = 8192, 4096, 8, 8
#: Passes over the training rows (more of them if they are too few for so many steps), windows in a step.
EPOCHS, STEPS, BATCH, RATE, SEED = 10, 400, 128, 0.02, 11
#: Share of the words of a step that are hidden, so that their characters have to do.
HIDDEN = 0.3
#: Windows that are read side by side.
ABREAST = 4096

Params = dict[str, np.ndarray]


def words_of(text: str = "text") -> F.Column:
    """Lower-cased runs of letters and digits; none for null."""
    return F.coalesce(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), F.array().cast("array<string>"))


def features(words: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: its number from 1 (0: unknown); the trigram buckets of all words, and where each begins."""
    known = pc.index_in(words, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False) + 1
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    octets = np.frombuffer("".join(words.to_pylist()).encode("utf-8", "surrogatepass"), np.uint8)
    begin = np.cumsum(sizes + 2) - sizes - 2
    padded = np.zeros(int(sizes.sum()) + 2 * len(sizes), np.int64)
    inner = np.ones(len(padded), bool)
    inner[begin] = inner[begin + sizes + 1] = False
    padded[inner] = octets
    key = padded[:-2] << 16 | padded[1:-1] << 8 | padded[2:] if len(padded) else padded
    bucket = (key * 2654435761 >> 11) % BUCKETS
    middle = np.flatnonzero(inner) - 1
    return known, bucket[middle], np.cumsum(sizes) - sizes


def inputs(p: Params, words: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The two vectors of each word, side by side."""
    known, grams, begin = words
    sizes = np.diff(np.append(begin, len(grams)))
    chars = np.add.reduceat(p["chars"][grams], begin, axis=0) / sizes[:, None].astype(np.float32)
    return np.concatenate([p["words"][known], chars], axis=1)


def _gate(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _read(p: Params, table: np.ndarray, ids: np.ndarray, lengths: np.ndarray, way: str, trace: list | None) -> np.ndarray:
    """The states of one direction at every word; ``lengths`` descend, ``table`` holds the words' gate inputs."""
    n, span = ids.shape
    states, h, u = np.zeros((n, span, STATE), np.float32), np.zeros((n, STATE), np.float32), p["u" + way]
    for t in range(int(lengths[0])):
        alive = int(np.searchsorted(-lengths, -t, side="left"))
        at = np.full(alive, t) if way == "f" else lengths[:alive] - 1 - t
        word = ids[np.arange(alive), at]
        g, before = table[word], h[:alive]
        r = before @ u
        gates = _gate(g[:, : 2 * STATE] + r[:, : 2 * STATE])
        z, keep = gates[:, :STATE], gates[:, STATE:]
        c = np.tanh(g[:, 2 * STATE :] + keep * r[:, 2 * STATE :])
        after = before + z * (c - before)
        if trace is not None:
            trace.append((at, word, before.copy(), z, keep, c, r[:, 2 * STATE :]))
        h[:alive] = after
        states[np.arange(alive), at] = after
    return states


def forward(p: Params, x: np.ndarray, ids: np.ndarray, lengths: np.ndarray, trace: dict | None = None) -> np.ndarray:
    """The logit of each window: rows of ``ids`` into ``x``, the first ``lengths`` of a row; lengths descend."""
    states = []
    for way in "fb":
        steps = None if trace is None else trace.setdefault(way, [])
        states.append(_read(p, x @ p["w" + way] + p["c" + way], ids, lengths, way, steps))
    both = np.concatenate(states, axis=2)
    weight = both @ p["attend"]
    weight = np.where(np.arange(ids.shape[1]) < lengths[:, None], weight, -np.inf)
    weight = np.exp(weight - weight.max(1, keepdims=True))
    weight /= weight.sum(1, keepdims=True)
    pooled = np.einsum("nt,nth->nh", weight, both)
    if trace is not None:
        trace |= {"both": both, "weight": weight, "pooled": pooled}
    return pooled @ p["out"] + p["bias"]


def gradients(p: Params, words, x: np.ndarray, ids: np.ndarray, lengths: np.ndarray, wanted: np.ndarray) -> tuple[float, Params]:
    """Mean log loss of the windows and its gradient by every parameter."""
    trace: dict = {}
    logit = forward(p, x, ids, lengths, trace)
    chance = _gate(logit)
    loss = float(np.mean(np.logaddexp(0, logit) - wanted * logit))
    d = ((chance - wanted) / len(wanted)).astype(np.float32)
    both, weight, pooled = trace["both"], trace["weight"], trace["pooled"]
    g: Params = {"out": pooled.T @ d, "bias": d.sum(keepdims=True)}
    d_pooled = d[:, None] * p["out"]
    d_weight = np.einsum("nh,nth->nt", d_pooled, both)
    d_score = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
    g["attend"] = np.einsum("nt,nth->h", d_score, both)
    d_both = weight[:, :, None] * d_pooled[:, None] + d_score[:, :, None] * p["attend"]
    d_x = np.zeros_like(x)
    for k, way in enumerate("fb"):
        u, d_states = p["u" + way], d_both[:, :, k * STATE : (k + 1) * STATE]
        d_u, d_table = np.zeros_like(u), np.zeros((len(x), 3 * STATE), np.float32)
        d_h = np.zeros((len(ids), STATE), np.float32)
        for at, word, before, z, keep, c, r in reversed(trace[way]):
            alive = len(at)
            d_after = d_h[:alive] + d_states[np.arange(alive), at]
            d_c = d_after * z * (1 - c * c)
            d_z = d_after * (c - before) * z * (1 - z)
            d_keep = d_c * r * keep * (1 - keep)
            d_r = np.concatenate([d_z, d_keep, d_c * keep], axis=1)
            d_u += before.T @ d_r
            d_h[:alive] = d_after * (1 - z) + d_r @ u.T
            np.add.at(d_table, word, np.concatenate([d_z, d_keep, d_c], axis=1))
        g |= {"u" + way: d_u, "w" + way: x.T @ d_table, "c" + way: d_table.sum(0)}
        d_x += d_table @ p["w" + way].T
    known, grams, begin = words
    sizes = np.diff(np.append(begin, len(grams)))
    g["words"], g["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
    np.add.at(g["words"], known, d_x[:, :WIDTH])
    np.add.at(g["chars"], grams, np.repeat(d_x[:, WIDTH:] / sizes[:, None].astype(np.float32), sizes, axis=0))
    return loss, g


def fresh(vocabulary: int, seed: int = SEED) -> Params:
    rng = np.random.default_rng(seed)

    def some(*shape, scale=0.3):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    p = {"words": some(vocabulary + 1, WIDTH, scale=0.1), "chars": some(BUCKETS, WIDTH), "attend": some(2 * STATE)}
    p |= {"out": some(2 * STATE), "bias": np.zeros(1, np.float32)}
    for way in "fb":
        p |= {"w" + way: some(2 * WIDTH, 3 * STATE), "u" + way: some(STATE, 3 * STATE), "c" + way: np.zeros(3 * STATE, np.float32)}
    return p


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of every window; a text without words has one of length 0."""
    each = np.maximum(1, -(-(counts - WINDOW) // STEP) + 1)
    text = np.repeat(np.arange(len(counts)), each)
    first = (np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)) * STEP
    return text, first, np.minimum(WINDOW, counts[text] - first)


def _rows(flat: np.ndarray, first: np.ndarray, length: np.ndarray, empty: int) -> np.ndarray:
    """The words of windows as a matrix; unused places hold ``empty``."""
    at = first[:, None] + np.arange(max(1, int(length.max())))
    inside = np.arange(at.shape[1]) < length[:, None]
    return np.where(inside, np.append(flat, empty)[np.where(inside, at, len(flat))], empty)


def logits(p: Params, words, flat: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The logit of each window of the word numbers ``flat``; a window without words reads one blank word."""
    blank = np.zeros((1, 2 * WIDTH), np.float32)
    x = np.concatenate([inputs(p, words), blank]) if len(words[0]) else blank
    out, order = np.empty(len(first), np.float32), np.argsort(-length, kind="stable")
    for at in range(0, len(order), ABREAST):
        some = order[at : at + ABREAST]
        ids = _rows(flat, first[some], length[some], len(x) - 1)
        out[some] = forward(p, x, ids, np.maximum(1, length[some]))
    return out


def fit(texts: pa.Array | list[list[str]], toxic: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> tuple[Params, pa.Array]:
    """Network and vocabulary of the training texts.

    A text is toxic if one of its windows is.  So each epoch scores all windows and learns from the worst
    window of every text, and from a random one of the others.  Some words are hidden, so that their
    characters have to do.
    """
    rng = np.random.default_rng(seed)
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.list_(pa.string()))
    coded = texts.flatten().dictionary_encode()
    flat = coded.indices.to_numpy().astype(np.int64)
    counts = pc.list_value_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    base, size = np.cumsum(counts) - counts, max(1, len(coded.dictionary))
    seen = np.bincount(np.unique(np.repeat(np.arange(len(texts)), counts) * size + flat) % size, minlength=len(coded.dictionary))
    often = np.flatnonzero(seen > 2)
    often = often[np.lexsort((often, -seen[often]))[:VOCABULARY]]
    vocabulary = coded.dictionary.take(pa.array(np.sort(often)))
    p = fresh(len(vocabulary), seed)
    if not len(toxic) or toxic.min() == toxic.max():
        p["out"][:] = 0
        p["bias"][:] = 0 if not len(toxic) else 4 * toxic[0] - 2
        return p, vocabulary
    words = features(coded.dictionary, vocabulary)
    text, first, length = windows(counts)
    first = first + base[text]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    batch = min(BATCH, max(16, len(texts) // 8))
    each = -(-len(texts) * 3 // 2 // batch)
    epochs = max(epochs, -(-STEPS // each))
    step, total = 0, epochs * each
    for epoch in range(epochs):
        score = logits(p, words, flat, first, length) + (rng.gumbel(size=len(first)) * 3 if epoch < 2 else 0)
        worst = np.lexsort((score, text))[np.append(np.flatnonzero(np.diff(text)), len(text) - 1)]
        spare = rng.permutation(len(first))
        clean = spare[toxic[text[spare]] == 0][: len(texts) // 2]
        picked = rng.permutation(np.concatenate([worst, clean]))
        for at in range(0, len(picked), batch):
            some = picked[at : at + batch]
            some = some[length[some] > 0]
            if not len(some):
                continue
            some = some[np.argsort(-length[some], kind="stable")]
            ids = _rows(flat, first[some], length[some], 0)
            used, ids = np.unique(ids, return_inverse=True)
            ids = ids.reshape(len(some), -1)
            mine = _only(words, used)
            mine = (np.where(rng.random(len(used)) < HIDDEN, 0, mine[0]), *mine[1:])
            _, g = gradients(p, mine, inputs(p, mine), ids, length[some], toxic[text[some]].astype(np.float32))
            step += 1
            pace = RATE * (1 - 0.9 * step / total) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, (m, v) in moments.items():
                m += 0.1 * (g[k] - m)
                v += 0.001 * (g[k] ** 2 - v)
                p[k] -= (pace * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return p, vocabulary


def _only(words, used: np.ndarray):
    """The features of some of the words."""
    known, grams, begin = words
    sizes = np.diff(np.append(begin, len(grams)))[used]
    start = np.cumsum(sizes) - sizes
    at = np.repeat(begin[used] - start, sizes) + np.arange(int(sizes.sum()))
    return known[used], grams[at], start


def held_out(folds: int, held: int) -> F.Column:
    """Whether a row is in the held-out fold: crc32 of doc_id as text.  A null doc_id is in none."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    return F.coalesce(fold == held, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, folds: int, held: int, rows: int = TRAIN_ROWS) -> tuple[pa.Array, np.ndarray]:
    """Words and labels of up to ``rows`` labelled documents of each class, those with the smallest hashes.

    The documents are picked from the labels, outside the held-out fold, and so few doc_ids are broadcast to
    the texts; no text is shuffled.  Rows with a null text, doc_id or label are left out; of several labels
    the highest counts.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(folds, held))
    marks = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    order = [F.xxhash64(F.lit(SEED), "id"), F.col("id")]
    of = lambda toxic: marks.where(F.col("toxic") == toxic).orderBy(*order).limit(rows)
    picked = of(0).unionByName(of(1)).toArrow()
    few = docs.sparkSession.createDataFrame(picked.to_pylist(), "id long, toxic int")
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(few), "id")
    some = texts.select("id", "toxic", words_of().alias("words"))
    # a doc_id may stand in any number of rows
    table = some.orderBy(*order, "words").limit(2 * rows).toArrow().combine_chunks()
    if not len(table):
        return pa.array([], pa.list_(pa.string())), np.empty(0, int)
    return table.column("words").combine_chunks(), table.column("toxic").to_numpy().astype(int)


def score(rows: DataFrame, model: tuple[Params, pa.Array]) -> DataFrame:
    """``rows`` (any one column, and ``words``) as (that column, score, predicted).

    All windows of the whole text are read; the score is the chance of the worst.  A text without words is one
    window with a blank word.
    """
    carried, words = rows.columns
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        p, vocabulary = sent.value
        for batch in batches:
            for at in range(0, len(batch), 500):
                piece = batch.slice(at, 500)
                coded = piece.column(1).flatten().dictionary_encode()
                counts = pc.list_value_length(piece.column(1)).to_numpy(zero_copy_only=False)
                text, first, length = windows(counts)
                first = first + (np.cumsum(counts) - counts)[text]
                found = logits(p, features(coded.dictionary, vocabulary), coded.indices.to_numpy(), first, length)
                worst = np.full(len(piece), -np.inf)
                np.maximum.at(worst, text, found)
                chance = _gate(worst)
                columns = [piece.column(0), pa.array(chance), pa.array((chance >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[carried, "score", "predicted"])

    kind = rows.schema[carried].dataType.simpleString()
    return rows.mapInArrow(run, f"{carried} {kind}, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs`` (doc_id, text), learned from ``labels``.

    Rows of the held-out fold are not learned from; a null doc_id has no label.  Other columns are ignored,
    repeated rows are answered each for itself.  Without rows of both classes every score is the same: 0.5
    without labels, else near the only class.
    """
    model = fit(*training_rows(docs, labels, folds, held))
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), held_out(folds, held).alias("held_out")).alias("key")
    return score(docs.select(key, words_of().alias("words")), model).select("key.*", "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all columns as they are.

    Each row is decided by itself as it passes, nothing is shuffled.
    """
    model = fit(*training_rows(docs, labels, folds, held))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    clean = score(docs.select(row, words_of().alias("words")), model).where("predicted = 0")
    return clean.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
