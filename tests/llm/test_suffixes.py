"""Repeated strings against a dictionary of all strings."""

import collections
import hashlib
import random

import pytest

from millrace.llm import entry, suffixes

from .conftest import SF


def brute(rows, repeat):
    seen = collections.Counter()
    bodies = [(d, (t or "").encode()) for d, t in rows]
    for _, b in bodies:
        seen.update(b[i : i + repeat] for i in range(len(b) - repeat + 1))
    out = []
    for d, b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - repeat + 1):
            if seen[b[i : i + repeat]] > 1:
                gone[i : i + repeat] = b"\1" * repeat
        left = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len([r for r in bytes(gone).split(b"\0") if r]), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_repeats_of_the_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute(rows, 400)
    assert got(entry.op2_suffix_dedup(spark, SF)) == want
    assert sum(r[2] for r in want) > 10_000


def rebuilt(rng):
    """Texts of shared, edited and periodic parts."""
    bank = ["".join(rng.choices("abcdé ", k=rng.randint(20, 300))) for _ in range(5)]
    for n in range(rng.randint(2, 12)):
        text = ""
        for _ in range(rng.randint(0, 7)):
            part = rng.choice(bank)
            k = rng.randrange(len(part))
            text += rng.choice([part, part[:k], part[k:], part[:k] + "X" + part[k + 1 :], "z" * rng.randint(1, 90), "xy" * 40, ""])
        yield n, text


@pytest.mark.parametrize("piece", [150, 1 << 17])
def test_repeats_of_odd_rows(spark, docs_of, monkeypatch, piece):
    monkeypatch.setattr(suffixes, "PIECE", piece)
    rng = random.Random(piece)
    for _ in range(5):
        rows = [(None, "k" * 70), (3, None), (3, ""), (4, "same words here " * 9), (4, "same words here " * 9), *rebuilt(rng)]
        for repeat in (50, 97, 190):
            assert got(suffixes.repeat_digest(docs_of(rows), repeat)) == brute(rows, repeat)
    assert suffixes.repeat_digest(docs_of([])).collect() == []


def test_cut_documents_are_text(spark, docs_of):
    docs = docs_of([(1, "é" * 300 + "tail"), (2, "start" + "é" * 300), (3, "other"), (4, None)])
    left = suffixes.cut_documents(docs)
    assert left.columns == docs.columns and dict(left.dtypes) == dict(docs.dtypes)
    assert {r.doc_id: (r.text, r.n_chars, r.lang, r.score) for r in left.collect()} == {
        1: ("tail", 4, "en", "x"), 2: ("start", 5, "en", "x"), 3: ("other", 5, "en", "x"), 4: ("", 0, "en", "x")
    }


def test_names_depend_on_content_only():
    import numpy as np

    text = bytes(random.Random(1).choices(range(256), k=900))
    a = suffixes.bytes_scale(400).names([text])
    b = suffixes.bytes_scale(400).names([b"123" + text])
    for length in (24, 25, 47, 48, 400, 760):
        for at in (0, 5, 130):
            x, y = (n.of(np.array([i]), np.array([length]))[0] for n, i in ((a, at), (b, at + 3)))
            z = a.of(np.array([at + 1]), np.array([length]))[0]
            assert x == y != z
