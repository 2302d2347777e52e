"""Passages that the pipeline removes, against a dictionary of all runs of 51 words."""

import collections
import random
import re

import corpus_pipeline as pipeline


def plain(texts, words=51):
    bodies = [(t or "").encode() for t in texts]
    at = [[m.span() for m in re.finditer(rb"\S+", b)] for b in bodies]
    runs = [[(w[k][0], w[k + words - 1][1]) for k in range(len(w) - words + 1)] for w in at]
    seen = collections.Counter(b[p:q] for b, r in zip(bodies, runs) for p, q in r)
    out = []
    for b, r in zip(bodies, runs):
        gone = bytearray(len(b))
        for p, q in r:
            if seen[b[p:q]] > 1:
                gone[p:q] = b"\1" * (q - p)
        out.append(bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore"))
    return out


def test_passages_count_by_words(spark, docs_of):
    rng = random.Random(5)
    some = lambda n, letters: " ".join(f"q{rng.randrange(10**7)}" for _ in range(n)) if letters else " ".join(rng.choices("abcdefghij", k=n))
    short, almost, long_ = some(51, 0), some(50, 0), some(50, 1)  # 101, 99 and over 400 bytes
    texts = [None, "", "few words"]
    for passage in (short, almost, long_, some(400, 1)):
        texts += [f"{some(40, 1)} {passage} {some(30, 1)}" for _ in range(2)]
    # overlapping repeats of 30 words each, that together hold 60
    left, right = some(40, 1), some(40, 1)
    texts += [f"{some(9, 1)} {left} {right} {some(9, 1)}", f"{some(9, 1)} {left} {some(9, 1)}", f"{some(9, 1)} {right} {some(9, 1)}"]
    rows = docs_of(list(enumerate(texts)))
    got = {r.doc_id: r for r in pipeline.passages(spark, rows, "").collect()}
    assert [got[i].text for i in range(len(texts))] == plain(texts)
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert short not in got[3].text and almost in got[5].text and long_ in got[7].text and left in got[11].text
