"""Removal of repeated byte strings by bucket-pointer refinement over the suffixes of a corpus.

Letters are bytes, or words with the white space behind them (for passages that are counted in words).
A suffix is known by identifiers: ``id[m](i)`` names the ``m`` letters at offset ``i``.  Names of short strings
are made first, and longer ones reuse them recursively: ``id[2m](i)`` is made of the identifiers at ``i`` and at
the later offset ``i + m``.  Equal strings have equal names wherever they stand, so buckets of suffixes can be
refined in any task.

To find all strings of 400 bytes that occur twice, not all suffixes are moved.  Each 400-byte string has an
anchor, its q-gram with the smallest identifier; equal strings have it at the same place, so they meet in the
bucket of that q-gram.  Buckets are refined in three steps:

0. *stretch*: a bucket is split by the name of all bytes around the anchor that its strings can reach.  Members
   with equal names are repeated as a whole.  One member of each name goes on if its bucket has several names.
1. *block*: the strings of a stretch in blocks of neighbours.  A block's ``core`` (bytes that all its strings
   share) is its new bucket, its ``full`` name (all their bytes) decides whether it is repeated as a whole.
2. *string*: single strings of the blocks whose core is shared and whose full name is not.

Buckets are aggregated by name, never gathered, so a bucket may hold any share of all suffixes.
Names have 64 bits, and strings are compared within the bucket of a q-gram with another 64-bit name only.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, slices, stored
from millrace.session import scratch_folder

#: Bytes of a repeated string, of a q-gram, strings in a block, and letters that are named at once.
REPEAT, GRAM, STRINGS, PIECE = 400, 24, 32, 1 << 17
#: Words of a q-gram, and strings of words in a block.
WORD_GRAM, WORD_STRINGS = 8, 8

MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of two names in this order."""
    x = a * MULTIPLIERS[0]
    x ^= b
    x *= MULTIPLIERS[1]
    x ^= x >> np.uint64(32)
    return x


_LETTERS = _mix(np.arange(1, 257, dtype=np.uint64), np.arange(257, 513, dtype=np.uint64))


#: A factor, and what undoes it modulo 2 ** 64.
_TURN, _BACK = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
#: Bytes that are no white space.
_INK = np.array([b not in b" \t\n\r\x0b\x0c" for b in range(256)])


def _powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base`` to each of the exponents, modulo 2 ** 64."""
    out, square, left = np.ones(len(exponents), np.uint64), base, exponents.copy()
    while left.any():
        digit = left & 255
        table = np.cumprod(np.array([1] + [square] * 255, np.uint64))
        out *= table[digit]
        left >>= 8
        square = pow(square, 256, 1 << 64)
    return out


class Words:
    """The words of a body, runs of bytes that are not white space, and names of what begins and ends with one.

    A polynomial modulo 2 ** 64 over the bytes names any substring by a difference of two sums.
    """

    def __init__(self, body: bytes) -> None:
        octets = np.frombuffer(body, np.uint8)
        ink = np.concatenate([[False], _INK[octets], [False]])
        self.begin = np.flatnonzero(ink[1:] & ~ink[:-1])
        self.end = np.flatnonzero(ink[:-1] & ~ink[1:])
        self._sums = np.zeros(len(octets) + 1, np.uint64)
        for at in range(0, len(octets), PIECE):
            some = np.arange(at, min(at + PIECE, len(octets)))
            self._sums[some + 1] = self._sums[at] + np.cumsum(_LETTERS[octets[some]] * _powers(_TURN, some))

    def named(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self._sums[end] - self._sums[begin]) * _powers(_BACK, begin), (end - begin).astype(np.uint64))

    def letters(self) -> np.ndarray:
        """The name of each word with the white space behind it; the last word is without."""
        return self.named(self.begin, np.append(self.begin[1:], self.end[-1:]))


class Scale(NamedTuple):
    """What a string is made of: letters, how many of them are a string and a q-gram, and strings in a block."""

    repeat: int
    gram: int
    strings: int
    read: Callable[[bytes], bytes | np.ndarray]

    def joined(self, buffers: list) -> np.ndarray:
        return np.concatenate(buffers) if isinstance(buffers[0], np.ndarray) else _LETTERS[np.frombuffer(b"".join(buffers), np.uint8)]

    def names(self, buffers: list) -> "Names":
        return Names(self.joined(buffers), self.gram, self.repeat)


def bytes_scale(repeat: int) -> Scale:
    """Strings of ``repeat`` bytes."""
    return Scale(repeat, GRAM, STRINGS, bytes)


def words_scale(words: int) -> Scale:
    """Strings of ``words`` words and the white space behind each: a letter is the name of one of these."""
    return Scale(words, WORD_GRAM, WORD_STRINGS, lambda body: Words(body).letters())


class Names:
    """Identifiers of all substrings of a buffer of letters, from ``gram`` letters to twice ``longest``."""

    def __init__(self, letters: np.ndarray, gram: int, longest: int) -> None:
        self.by: dict[int, np.ndarray] = {}
        now, m = letters, 1
        while 2 * m <= gram:
            now, m = _mix(now[: max(0, len(now) - m)], now[m:]), 2 * m
        if m < gram:
            now, m = _mix(now[: max(0, len(now) - (gram - m))], now[gram - m :]), gram
        self.by[m] = now
        while 2 * m <= longest:
            now, m = _mix(now[: max(0, len(now) - m)], now[m:]), 2 * m
            self.by[m] = now
        if m < longest:  # then two names cover any substring of up to twice the longest
            self.by[longest] = _mix(now[: max(0, len(now) - (longest - m))], now[longest - m :])
        self.sizes = np.array(sorted(self.by))

    def of(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The name of each substring: of its first and its last part that have a name of their own."""
        out = np.zeros(len(start), np.uint64)
        kind = np.searchsorted(self.sizes, length, side="right") - 1
        for k in np.unique(kind):
            mine, m = kind == k, int(self.sizes[k])
            out[mine] = _mix(self.by[m][start[mine]], self.by[m][start[mine] + length[mine] - m])
        return out ^ length.astype(np.uint64)


def _packed(at, low, high):
    """An anchor and its strings, from ``low`` to ``high`` bytes before it, as one long."""
    return at.astype(np.int64) << 20 | low.astype(np.int64) << 10 | high.astype(np.int64)


def _unpacked(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return places >> 20, places >> 10 & 1023, places & 1023


def _anchors(names: Names, firsts: np.ndarray, counts: np.ndarray, scale: Scale):
    """(anchor, first string, last string) in the buffer, for strings at ``firsts`` + 0 .. ``counts`` - 1.

    The anchor of a string is its leftmost q-gram with the smallest upper 32 bits.
    """
    grams = names.by[scale.gram]
    low = grams & ~np.uint64(0xFFFFFFFF) | np.arange(len(grams), dtype=np.uint64)
    width, m = scale.repeat - scale.gram + 1, 1
    while 2 * m <= width:
        low, m = np.minimum(low[:-m], low[m:]), 2 * m
    if m < width:
        low = np.minimum(low[: len(low) - (width - m)], low[width - m :])
    begin = np.repeat(firsts - np.cumsum(counts) + counts, counts)
    starts = begin + np.arange(counts.sum())
    anchor = (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    last = np.append(edge[1:], len(starts)) - 1
    return anchor[edge], starts[edge], starts[last]


def _stretches(texts: list[tuple[int, bytes | np.ndarray]], scale: Scale) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, place, q-gram name, stretch name) of every anchor of the texts.

    Short texts are named together, a text longer than PIECE in overlapping parts.
    """
    repeat, reach = scale.repeat, scale.repeat - scale.gram
    held: list[tuple[int, bytes | np.ndarray, int, int]] = []  # row, text, first and one after the last string
    size = 0

    def named(parts):
        buffers, at, rows, offsets, firsts, counts, lengths = [], 0, [], [], [], [], []
        for row, text, first, end in parts:
            left = max(0, first - reach)
            cut = text[left : end + repeat + reach + repeat]
            buffers.append(cut)
            rows.append(row), offsets.append(at - left), firsts.append(at + first - left)
            counts.append(end - first), lengths.append(len(text))
            at += len(cut)
        names = scale.names(buffers)
        firsts, offsets = np.array(firsts), np.array(offsets)
        anchor, low, high = _anchors(names, firsts, np.array(counts), scale)
        part = np.searchsorted(firsts, low, side="right") - 1
        place = anchor - offsets[part]
        left, right = np.minimum(place, reach), np.minimum(np.array(lengths)[part] - place, repeat)
        whole = _mix(names.of(anchor - left, left + right), (left << 10 | right).astype(np.uint64))
        return np.array(rows)[part], place, anchor - high, anchor - low, names.by[scale.gram][anchor], whole

    def flush():
        row, place, low, high, gram, whole = named(held)
        return row, _packed(place, low, high), gram, whole

    for row, text in texts:
        strings = len(text) - repeat + 1
        if strings <= 0:
            continue
        if len(text) > PIECE:
            parts = [named([(row, text, k, min(k + PIECE, strings))]) for k in range(0, strings, PIECE)]
            rows, place, low, high, gram, whole = (np.concatenate(x) for x in zip(*parts))
            first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))  # an anchor on a seam is one
            low, high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
            yield rows[first], _packed(place[first], low, high), gram[first], whole[first]
            continue
        held.append((row, text, 0, strings))
        size += len(text)
        if size > PIECE:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _requests(rows, scale: Scale) -> Iterator[tuple[Names, np.ndarray, ...]]:
    """(names, row, anchor in the buffer, place, low, high, bytes left and right of it in the text)."""
    repeat, reach = scale.repeat, scale.repeat - scale.gram
    buffers, at, out = [], 0, []

    def flush():
        joined = [np.concatenate(x) for x in zip(*out)]
        return scale.names(buffers), *joined

    for row, text, places in rows:
        anchor, low, high = _unpacked(np.sort(np.asarray(places, np.int64)))
        k = 0
        while k < len(anchor):
            left = max(0, int(anchor[k]) - reach)
            end = k + 1
            while end < len(anchor) and anchor[end] - reach <= anchor[end - 1] + repeat and anchor[end] - left < PIECE:
                end += 1
            mine = slice(k, end)
            a, cut = anchor[mine], text[left : int(anchor[end - 1]) + repeat]
            out.append((np.full(end - k, row), a - left + at, a, low[mine], high[mine], np.minimum(a, reach), np.minimum(len(text) - a, repeat)))
            buffers.append(cut)
            at += len(cut)
            k = end
            if at > PIECE:
                yield flush()
                buffers, at, out = [], 0, []
    if out:
        yield flush()


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each unit of ``counts``: whose it is, and which of it."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _blocks(rows, scale: Scale) -> Iterator[tuple[np.ndarray, ...]]:
    repeat, strings = scale.repeat, scale.strings
    for names, row, anchor, place, low, high, left, right in _requests(rows, scale):
        owner, k = _spread(high // strings - low // strings + 1)
        block = low[owner] // strings + k
        near, far = block * strings, np.minimum(block * strings + strings - 1, repeat - scale.gram)
        at = anchor[owner]
        core = names.of(at - near, repeat + near - far)
        before, after = np.minimum(far, left[owner]), np.minimum(repeat - near, right[owner])
        full = _mix(names.of(at - before, before + after), (before << 10 | after).astype(np.uint64))
        places = _packed(place[owner], np.maximum(near, low[owner]), np.minimum(far, high[owner]))
        yield row[owner], places, names.by[scale.gram][at], block, core, full


def _strings(rows, scale: Scale) -> Iterator[tuple[np.ndarray, ...]]:
    for names, row, anchor, place, low, high, _, _ in _requests(rows, scale):
        owner, k = _spread(high - low + 1)
        before = low[owner] + k
        name = names.of(anchor[owner] - before, np.full(len(owner), scale.repeat))
        yield row[owner], _packed(place[owner], before, before), names.by[scale.gram][anchor[owner]], before, name, name


KEYS = ("gram", "part", "core", "whole")
ITEM = "row long, place long, gram long, part int, core long, whole long"


def _item_batches(found: Iterator[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    for row, place, gram, part, core, whole in found:
        for at in range(0, len(row), 20_000):
            cut = slice(at, at + 20_000)
            signed = [pa.array(x[cut].view(np.int64)) for x in (gram, core, whole)]
            columns = [pa.array(row[cut]), pa.array(place[cut]), signed[0], pa.array(part[cut].astype(np.int32)), *signed[1:]]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "place", "gram", "part", "core", "whole"])


def _refine(items: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(places that are repeated as a whole, one place of each name in buckets with several names, tables of use)."""
    one = F.min(F.struct("row", "place")).alias("one")
    names = stored(items.groupBy(*KEYS).agg(F.count("*").alias("n"), one), "names")
    repeated = items.join(names.where("n > 1").select(*KEYS), list(KEYS)).select("row", "place")
    # stored, so that the join below has a shuffle on either side and a large bucket can be split
    buckets = stored(names.groupBy(*KEYS[:3]).agg(F.count("*").alias("names")).where("names > 1"), "buckets")
    return repeated, names.join(buckets, list(KEYS[:3])).select("one.row", "one.place"), [names, buckets]


def _numbered(docs: DataFrame, carried: list[str]) -> DataFrame:
    """``docs`` as a stored table of (row, carried, body), bucketed by row; ``carried`` is a struct of columns.

    Three joins bring lists of places to the bodies; with the bodies in buckets only the lists are shuffled.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body")
    kept = F.struct(*[F.col(f"`{c}`") for c in carried]).alias("carried")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), kept, body)
    name = f"millrace_bodies_{uuid.uuid4().hex}"
    target = rows.repartition(n, "row").write.option("path", scratch_folder(spark, "bodies")).option("compression", "zstd")
    target.bucketBy(n, "row").saveAsTable(name)
    return spark.table(name)


def _at_places(bodies: DataFrame, wanted: DataFrame, find, scale: Scale) -> DataFrame:
    """The items that ``find`` makes of the wanted places (row, place), with the bodies at hand."""
    lists = wanted.groupBy("row").agg(F.collect_list("place").alias("places"))

    def run(batches):
        for batch in slices(batches, "body"):
            rows, texts, places = (c.to_pylist() for c in batch.columns)
            yield from _item_batches(find(zip(rows, map(scale.read, texts), places), scale))

    return bodies.select("row", "body").join(lists, "row").mapInArrow(run, ITEM)


def repeated_places(bodies: DataFrame, scale: Scale) -> list[DataFrame]:
    """(row, place) of all strings of the scale that also start anywhere else in ``bodies``: three stored tables.

    Anchors of words are left out early if their q-gram is the anchor of no other strings; those of bytes are
    too few for that to pay.  What a step leaves behind is removed when the next one is stored.
    """

    def run(batches):
        for batch in slices(batches, "body"):
            texts = list(zip(batch.column(0).to_pylist(), map(scale.read, batch.column(1).to_pylist())))
            for row, place, gram, whole in _stretches(texts, scale):
                yield from _item_batches([(row, place, gram, np.zeros(len(row), np.int32), gram, whole)])

    stretches = bodies.select("row", "body").mapInArrow(run, ITEM)
    if scale.gram == WORD_GRAM:
        anchors = stored(stretches.select("row", "place", "gram", "whole"), "anchors")
        shared = stored(anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "grams")
        stretches = anchors.join(shared, "gram", "left_semi").select("row", "place", "gram", F.lit(0).alias("part"), F.col("gram").alias("core"), "whole")
        stretches = stored(stretches, "stretches")
        discard(anchors, shared)
    else:
        stretches = stored(stretches, "stretches")
    found = []
    items = stretches
    for find in (_blocks, _strings):
        repeated, open_items, used = _refine(items)
        found.append(stored(repeated, "repeated"))
        following = stored(_at_places(bodies, open_items, find, scale), find.__name__.strip("_"))
        discard(items, *used)
        items = following
    repeated, _, used = _refine(items)
    found.append(stored(repeated, "repeated"))
    discard(items, *used)
    return found


def merged_spans(places, repeat: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by the strings at ``places``, in order."""
    anchor, low, high = _unpacked(np.asarray(places or [], np.int64))
    return joined_spans(list(zip((anchor - high).tolist(), (anchor - low + repeat).tolist())))


def joined_spans(pieces: list[tuple[int, int]]) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    for begin, end in sorted(pieces):
        if spans and begin <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((begin, end))
    return spans


def _repeated_passages(bodies: DataFrame, places: DataFrame, words: int) -> DataFrame:
    """(row, word) of the first word of each run of ``words`` words that is repeated byte by byte; stored.

    ``places`` are repeated strings of one word less, with the white space behind each; only those can begin
    such a run.
    """
    lists = places.groupBy("row").agg(F.collect_list("place").alias("places"))
    schema = pa.schema([("row", pa.int64()), ("word", pa.int32()), ("name", pa.int64())])

    def run(batches):
        for batch in slices(batches, "body"):
            for row, body, held in zip(*(c.to_pylist() for c in batch.columns)):
                of = Words(body)
                anchor, low, high = _unpacked(np.asarray(held, np.int64))
                owner, k = _spread(high - low + 1)
                first = np.unique(anchor[owner] - high[owner] + k)
                first = first[first + words <= len(of.begin)]
                names = of.named(of.begin[first], of.end[first + words - 1]).view(np.int64)
                for at in range(0, len(first), 20_000):
                    some = slice(at, at + 20_000)
                    columns = [pa.array(np.full(len(first[some]), row)), pa.array(first[some].astype(np.int32)), pa.array(names[some])]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    met = bodies.select("row", "body").join(lists, "row")
    windows = stored(met.mapInArrow(run, "row long, word int, name long"), "windows")
    twice = stored(windows.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "twice")
    found = stored(windows.join(twice, "name").select("row", "word"), "passages")
    discard(windows, twice)
    return found


def passage_spans(body: bytes, first: list[int] | None, words: int) -> list[tuple[int, int]]:
    """Maximal byte runs of the runs of ``words`` words that begin with the words ``first``, in order."""
    if not first:
        return []
    of, first = Words(body), np.asarray(first)
    return joined_spans(list(zip(of.begin[first].tolist(), of.end[first + words - 1].tolist())))


def _cut(docs: DataFrame, repeat: int, carried: list[str], answer, schema: str, words: int = 0) -> DataFrame:
    """(carried, and ``answer(body, spans)`` in the order of ``schema``) for each row of ``docs``.

    Spans are the repeated strings of ``repeat`` bytes, or with ``words`` the repeated runs of so many words.
    """
    scale = words_scale(words - 1) if words else bytes_scale(repeat)
    if not scale.gram < scale.repeat < 1000:
        raise ValueError(f"repeats of {GRAM + 1} to 999 bytes or {WORD_GRAM + 2} to 1000 words are supported, not {words or repeat}")
    bodies = _numbered(docs, carried)
    parts = repeated_places(bodies, scale)
    found = reduce(DataFrame.unionByName, parts)
    if words:
        found = _repeated_passages(bodies, found, words)
        discard(*parts)
    lists = found.groupBy("row").agg(F.collect_list(found.columns[1]).alias("places"))
    fields = [field.split() for field in schema.split(", ")]
    names, types = ["carried", *(n for n, _ in fields)], [{"long": pa.int64(), "string": pa.string()}[t] for _, t in fields]

    def run(batches):
        for batch in slices(batches, "body"):
            held = zip(*(batch.column(k).to_pylist() for k in (1, 2)))
            rows = [answer(body, passage_spans(body, at, words) if words else merged_spans(at, repeat)) for body, at in held]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names=names)

    met = bodies.join(lists, "row", "left").select("carried", "body", "places")
    return met.mapInArrow(run, f"carried {bodies.schema['carried'].dataType.simpleString()}, {schema}")


def _rest(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(body)]
    return b"".join(body[p:q] for p, q in zip(edges[::2], edges[1::2]))


def repeat_digest(docs: DataFrame, repeat: int = REPEAT) -> DataFrame:
    """What is left of each row of ``docs`` (doc_id, text) without its repeated bytes, as counts and a hash.

    Null texts are empty.  Rows with the same or no doc_id are texts of their own, so a text that stands in two
    rows is repeated.  Texts shorter than ``repeat`` bytes stay whole.  Other columns are ignored.
    """

    def answer(body, spans):
        removed = sum(q - p for p, q in spans)
        return len(body), removed, len(spans), hashlib.sha256(_rest(body, spans)).hexdigest()

    keyed = docs.select(F.col("doc_id").cast("long"), "text")
    found = _cut(keyed, repeat, ["doc_id"], answer, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return found.select("carried.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def cut_passages(docs: DataFrame, words: int) -> DataFrame:
    """All rows and columns of ``docs`` with texts without passages of ``words`` words or more that are repeated.

    Words are runs of bytes that are not white space; a passage goes from the first byte of its first word to
    the last of its last, and is repeated byte by byte.  The refinement runs over words instead of bytes: first
    for strings of one word less, with the white space behind each, then for the passages that these begin.
    Null and empty texts and those with fewer words stay as they are; rows that repeat a text repeat its
    passages, whatever their doc_id; an empty table gives no rows.
    """
    return cut_documents(docs, words=words)


def cut_documents(docs: DataFrame, repeat: int = REPEAT, words: int = 0) -> DataFrame:
    """All rows and columns of ``docs`` with texts without their repeated bytes; ``n_chars``, if there, anew.

    Of a character that is removed in part, the other bytes go as well.  A text that is repeated as a whole
    becomes empty.
    """

    def answer(body, spans):
        return (_rest(body, spans).decode("utf-8", "ignore"),)

    found = _cut(docs, repeat, [c for c in docs.columns if c != "text"], answer, "text string", words)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*[new.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])
