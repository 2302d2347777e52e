"""What workers hold of the language model does not change predictions."""

import pytest

from millrace.llm import langid


def test_result_does_not_depend_on_the_bound(spark, monkeypatch):
    texts = [("the cat sat on the mat", "en"), ("le chat est sur le tapis", "fr"), ("die katze liegt dort", "de")] * 3 + [("zorblax", "fr"), ("zorblin the cats", None), ("жж", None), (None, "en")]
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(texts)], "doc_id long, text string, lang string")
    answers = lambda: {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, folds=1, held=5).collect()}
    want = answers()
    monkeypatch.setattr(langid, "MAX_BYTES", 150)
    got = answers()
    assert {d: x for d, (x, _) in got.items()} == {d: x for d, (x, _) in want.items()} and got[9][0] == "fr"
    assert all(got[d][1] == pytest.approx(s) for d, (_, s) in want.items())
