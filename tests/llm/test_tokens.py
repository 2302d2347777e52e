"""Token ids, plane files and packing against plain code."""

import collections
import io
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import entry, packing, planes, tokens

from .conftest import SF

ODD = [None, "", " ", "a", "a  b", "x \n y", "\tz ", "naïve café 日本", "<|endoftext|> it's", "w " * 9000, "a", "é\n\nb c"]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(tokens.vocabulary_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("joined", [1, 7, 1000])
def test_encoder_equals_the_library(plain, monkeypatch, joined):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 500)
    monkeypatch.setattr(tokens, "JOINED", joined)
    rng = random.Random(5)
    signs = ["a", "b'", "'s", " ", " ", "  ", "\n", "\t", "é", "日", "1", "22", ".", ",", "\x1c", "\x85", "\r\n", "_", "😀", " "]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 14))) for _ in range(8000)]
    encoder = tokens.Encoder(tokens.vocabulary_path())
    for at in range(0, len(texts), 1000):
        for text, ids in zip(texts[at : at + 1000], encoder.many(texts[at : at + 1000])):
            assert np.frombuffer(ids, "<u4").tolist() == plain(text), text


def test_names_of_special_tokens():
    path = tokens.vocabulary_path()
    text = "a <|endoftext|> b"
    of = lambda encoder: np.frombuffer(encoder.many([text])[0], "<u4").tolist()
    assert of(tokens.Encoder(path)) == [64, 220, 50256, 275]
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    assert of(tokens.Encoder(path, plain_names=True)) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [False, True])
def test_plane_file_round_trip(bits, monkeypatch):
    monkeypatch.setattr(planes, "BLOCK_IDS", 1000)
    rng = np.random.default_rng(1)
    docs = [(d, rng.integers(0, 2**32, n).astype("<u4")) for d, n in [(None, 0), (-5, 3), (1, 2500), (1, 0), (9, 1000)]]
    out = io.BytesIO()
    writer = planes.PlaneWriter(out, bits)
    for d, ids in docs:
        writer.add(d, ids.tobytes())
    assert writer.close() == (5, 3503, len(out.getvalue()))
    file = planes.PlaneReader(out)
    back = collections.defaultdict(list)
    for d, ids in file.runs():
        back[d] += ids.tolist()
    assert [back[d] for d in range(5)] == [ids.tolist() for _, ids in docs]
    assert file.null.tolist() == [1, 0, 0, 0, 0] and file.doc_ids.tolist() == [0, -5, 1, 1, 9]
    assert file.block(1).tolist() == np.concatenate([i for _, i in docs])[1000:2000].tolist()
    with pytest.raises(ValueError):
        planes.PlaneReader(io.BytesIO(out.getvalue()[:-1]))


def expected_digest(rows, plain):
    start, want = 0, []
    for d, text in rows:
        ids = np.array([*plain(text), 2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return want


def test_token_planes_of_the_table(spark, plain):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = entry.op4_token_planes(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected_digest(rows, plain)


def test_token_planes_of_odd_rows(spark, docs_of, plain):
    rows = [*enumerate(ODD), (None, "n"), (3, "a"), (3, "a")]
    got = [tuple(r) for r in planes.token_digest(docs_of(rows), bits=True).orderBy("start").collect()]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == expected_digest(order, plain)
    assert planes.token_digest(docs_of([])).collect() == []


def check_packing(rows, docs, plain):
    """Pieces are right, and sequences are filled without gaps."""
    want = collections.Counter()
    for d, text in docs:
        ids = [*plain(text), 0]
        first = len(ids) % 2048 or 2048 if len(ids) > 2048 else len(ids)
        cuts = [0, *range(first, len(ids) + 1, 2048)] if len(ids) > 2048 else [0, len(ids)]
        for k, (p, q) in enumerate(zip(cuts, cuts[1:])):
            want[d, k, p, q - p, zlib.crc32(np.array(ids[p:q], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 2048
    return len(sequences)


def test_packing_of_the_table(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = entry.op1_best_fit_packing(spark, SF).collect()
    assert check_packing(rows, docs, plain) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_packing_of_odd_rows(spark, docs_of, plain, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 3)
    docs = [*enumerate(ODD), (None, "n"), (3, "a"), (3, "a"), *((100 + k, "same") for k in range(40))]
    rows = packing.pack_documents(docs_of(docs), keep_ids=True).collect()
    check_packing(rows, docs, plain)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert packing.pack_documents(docs_of([])).collect() == []


def test_plan_is_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(200):
        capacity = rng.randint(1, 40)
        counts = {rng.randint(1, capacity): rng.randint(1, 9) for _ in range(rng.randint(0, 12))}
        bins = []
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                fits = [b for b in bins if b[0] >= length]
                best = min(fits, key=lambda b: b[0]) if fits else [capacity]
                if not fits:
                    bins.append(best)
                best[0] -= length
        taken = collections.defaultdict(list)
        for length, rank, n, first, offset in packing.plan_slots(counts, capacity):
            for i in range(n):
                taken[first + i].append((offset, length))
        assert len(taken) == len(bins)
        for held in taken.values():
            ends = 0
            for offset, length in sorted(held):
                assert offset == ends
                ends += length
            assert ends <= capacity
        assert sum(map(len, taken.values())) == sum(counts.values())
