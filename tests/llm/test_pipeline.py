"""The stages of the pipeline, each on its own input, against plain code."""

import collections

import duckdb
import pytest

import corpus_pipeline as pipeline
from millrace.llm import mixing

from .test_passages import plain as without_passages
from .test_simhash import expected
from .test_tokens import check_packing, plain  # noqa: F401

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    """The documents before and after each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(pipeline.stored(stage(spark, out[-1], SF), name))
    return out


def test_stages_keep_the_columns(kept):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "suffix_dedup", "hierarchical_mixing", "best_fit_packing"]
    assert all(f.columns == kept[0].columns and f.dtypes == kept[0].dtypes for f in kept[1:-1])
    sizes = [f.count() for f in kept[:-1]]
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4] > 300


def test_toxic_documents_go_and_clean_ones_stay(spark, kept):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r.doc_id for r in kept[1].select("doc_id").collect()}
    clean = [d in left for d, t in labels.items() if not t]
    foul = [d in left for d, t in labels.items() if t]
    assert sum(clean) >= 0.98 * len(clean) and sum(foul) <= 0.1 * len(foul)


def test_one_of_each_group_stays(kept):
    rows = [(r.doc_id, r.text) for r in kept[1].collect()]
    want = {d for d, _, c in expected(rows) if d == c}
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted(want)


def test_passages_go(kept):
    rows = [(r.doc_id, r.text) for r in kept[2].collect()]
    want = dict(zip([d for d, _ in rows], without_passages([t for _, t in rows], pipeline.PASSAGE)))
    got = {r.doc_id: r for r in kept[3].collect()}
    assert {d: r.text for d, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())
    assert sum(len(t or "") for _, t in rows) - sum(map(len, want.values())) > 1000


def test_mix_is_that_of_the_sql(kept):
    con = duckdb.connect()
    documents = kept[3].toArrow()  # noqa: F841
    want = con.sql(mixing.mixture_sql(pipeline.PERCENT, 1)).fetchall()
    assert sorted(r.doc_id for r in kept[4].collect()) == sorted(w[0] for w in want)


def test_packing_holds_all(kept, plain):  # noqa: F811
    docs = [(r.doc_id, r.text) for r in kept[4].collect()]
    rows = kept[5].collect()
    assert check_packing(rows, docs, plain) <= 1.02 * sum(r.length for r in rows) / 2048 + 1


def test_run_is_all_stages(spark, kept):
    got = pipeline.run(spark, SF)
    key = lambda f: collections.Counter((r.doc_id, r.piece, r.ids_crc32) for r in f.collect())
    assert got.columns == kept[5].columns and key(got) == key(kept[5])
