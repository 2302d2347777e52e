"""The network against finite differences, a step-by-step reading, and held-out labels."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import entry, toxicity as tox

from .conftest import SF


@pytest.fixture(scope="module")
def small():
    texts = [["xx", "ab", "cd", "zz", "q"], ["ab", "cd", "ef"], ["é"]]
    coded = pa.array([w for t in texts for w in t]).dictionary_encode()
    words = tox.features(coded.dictionary, pa.array(["ab", "cd"]))
    lengths = np.array([5, 3, 1])
    ids = tox._rows(coded.indices.to_numpy(), np.cumsum(lengths) - lengths, lengths, 0)
    return {k: v.astype(float) for k, v in tox.fresh(2).items()}, words, ids, lengths


def test_gradients(small):
    p, words, ids, lengths = small
    wanted = np.array([1.0, 0, 1])
    loss = lambda: tox.gradients(p, words, tox.inputs(p, words), ids, lengths, wanted)
    _, g = loss()
    for name, value in p.items():
        at = np.unravel_index(np.abs(g[name]).argmax(), value.shape)
        kept, step = value[at], 1e-3
        value[at] = kept + step
        up = loss()[0]
        value[at] = kept - step
        down = loss()[0]
        value[at] = kept
        assert g[name][at] == pytest.approx((up - down) / 2 / step, rel=2e-2), name


def test_forward_reads_as_defined(small):
    p, words, ids, lengths = small
    x = tox.inputs(p, words)
    sigmoid = lambda a: 1 / (1 + np.exp(-a))
    for row, n, got in zip(ids, lengths, tox.forward(p, x, ids, lengths)):
        states = np.zeros((n, 2 * tox.STATE))
        for k, way in enumerate("fb"):
            h = np.zeros(tox.STATE)
            for t in range(n) if way == "f" else reversed(range(n)):
                a, b = x[row[t]] @ p["w" + way] + p["c" + way], h @ p["u" + way]
                z, keep = np.split(sigmoid(a[: 2 * tox.STATE] + b[: 2 * tox.STATE]), 2)
                h = (1 - z) * h + z * np.tanh(a[2 * tox.STATE :] + keep * b[2 * tox.STATE :])
                states[t, k * tox.STATE : (k + 1) * tox.STATE] = h
        weight = np.exp(states @ p["attend"])
        assert got == pytest.approx(((weight / weight.sum()) @ states @ p["out"] + p["bias"])[0], abs=1e-5)


def test_windows_cover_every_word():
    counts = np.array([0, 1, tox.WINDOW, tox.WINDOW + 1, 500])
    text, first, length = tox.windows(counts)
    for k, n in enumerate(counts):
        covered = {w for f, m in zip(first[text == k], length[text == k]) for w in range(f, f + m)}
        assert covered == set(range(n)) and (text == k).any()


def test_score_of_the_table(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = entry.op3_toxicity(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) > 0.9


def test_odd_rows(spark, docs_of, monkeypatch):
    monkeypatch.setattr(tox, "EPOCHS", 6)
    clean, foul = "the cat sat on a mat today", "you are a rotten gloob indeed"
    rows = [(i, foul if i % 3 == 0 else clean) for i in range(90)] + [(None, foul), (500, None), (501, ""), (502, clean * 400 + " gloob"), (502, "gloob")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), "x") for i in range(90)] + [(None, 1, "x"), (3, None, "x")], "doc_id long, toxic int, text string")
    got = tox.toxicity(docs_of(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.predicted for r in got if r.doc_id is not None and r.doc_id < 90 and r.doc_id % 3 == 0} == {1}
    assert {r.predicted for r in got if r.doc_id is not None and r.doc_id < 90 and r.doc_id % 3} == {0}
    assert [r.predicted for r in got if r.doc_id is None] == [1]
    kept = tox.keep_clean(docs_of(rows), labels)
    assert kept.columns == docs_of(rows).columns
    assert {r.doc_id for r in kept.collect()} >= {1, 500, 501}
    assert {r.score for r in tox.toxicity(docs_of(rows), labels.limit(0)).collect()} == {0.5}
    assert tox.toxicity(docs_of([]), labels).collect() == []
