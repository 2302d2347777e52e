"""Language identification: counts, backoff, held-out accuracy."""

import collections
import random
import zlib

import numpy as np
import pytest
import regex

from millrace.llm import entry, langid

SF = "/root/testdata/sf0.01"


def test_prediction_of_the_table(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = entry.op9_language_id(spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [truth[r.doc_id] == r.lang_pred for r in rows if r.held_out]
    assert len(held) > 100 and np.mean(held) > 0.95


def plain(rows, folds=1, held=5):
    """(lang_pred, score) of rows (doc_id, text, lang) by dictionaries."""
    words_of = lambda t: regex.findall(r"\p{L}+", (t or "").lower())
    train = [(t, x) for d, t, x in rows if d is not None and t is not None and x is not None and zlib.crc32(str(d).encode()) % folds != held]
    langs = sorted({x for t, x in train if words_of(t)})
    words = {x: collections.Counter(w for t, y in train if y == x for w in words_of(t)) for x in langs}
    grams = {x: collections.Counter() for x in langs}
    for x in langs:
        for w, k in words[x].items():
            for n in range(1, 5):
                for i in range(len(w) + 3 - n):
                    grams[x][f"^{w}$"[i : i + n]] += k
    seen = {w for x in langs for w in words[x]}
    known = {g for x in langs for g in grams[x]}

    def logs(of, key, same):
        kinds = len({k for x in langs for k in of[x] if same(k)})
        return np.array([np.log((of[x][key] + 0.5) / (sum(c for k, c in of[x].items() if same(k)) + 0.5 * (kinds + 1))) for x in langs])

    def score_of(w):
        if w in seen:
            return logs(words, w, lambda k: True)
        for n in range(4, 0, -1):
            found = [g for i in range(len(w) + 3 - n) if (g := f"^{w}$"[i : i + n]) in known]
            if found:
                return np.mean([logs(grams, g, lambda k, n=n: len(k) == n) for g in found], 0)
        return np.zeros(len(langs))

    out = []
    for _, t, _ in rows:
        if not langs or not words_of(t):
            out.append(("und", 0.0))
            continue
        total = sum(score_of(w) for w in words_of(t))
        out.append((langs[int(total.argmax())], 1 / np.exp(total - total.max()).sum()))
    return out


@pytest.mark.parametrize("most", [16 << 20, 150])
def test_predictions_equal_a_plain_scorer(spark, monkeypatch, most):
    monkeypatch.setattr(langid, "MAX_BYTES", most)
    monkeypatch.setattr(langid, "MAX_BROADCAST", most)
    rng = random.Random(3)
    bank = {"en": "the cat sat on a mat with that hat", "fr": "le chat est sur la table avec ce chapeau", "de": "die katze sitzt dort auf dem tisch ä"}
    rows = [(i, " ".join(rng.choices(bank[x].split(), k=rng.randint(1, 9))), x) for i, x in enumerate(["en", "fr", "de"] * 8)]
    rows += [(100 + i, " ".join("".join(rng.choices("acehtsxzж", k=rng.randint(1, 7))) for _ in range(rng.randint(1, 6))), None) for i in range(60)]
    rows += [(200, None, "en"), (201, "12 !", "fr"), (202, "Le CHAT, chats; katzen", None), (None, "dort", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, folds=1, held=5).collect()}
    for (d, _, _), (name, score) in zip(rows, plain(rows)):
        assert got[d][0] == name and got[d][1] == pytest.approx(score), d


def test_odd_rows(spark):
    ids = [i for i in range(1, 200) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(ids[k], t, x) for k, (t, x) in enumerate([("hello there world", "en"), ("bonjour le monde", "fr"), ("guten tag", "de"), ("x", None), (None, "en")])]
    rows += [(None, "bonjour", "de"), (ids[0], "hello", "en"), (900, None, None), (901, "", None), (902, "12 !?", None), (903, "monde " * 9000, None)]
    docs = spark.createDataFrame([(d, t, x, "s", 1, "n", False) for d, t, x in rows], "doc_id long, text string, lang string, source string, n int, word string, held_out boolean")
    got = {(r.doc_id, r.held_out): (r.lang_pred, r.score) for r in langid.identify(docs).collect()}
    assert got[None, False][0] == "fr"
    by = {d: v for (d, _), v in got.items()}
    assert by[900] == by[901] == by[902] == ("und", 0.0) and by[903][0] == "fr"
    assert langid.identify(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.identify(docs.where("lang is null")).collect()} == {"und"}
