import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs_of(spark):
    """Rows of (doc_id, text) as a frame with further columns, two of them with names operators use."""

    def make(rows):
        full = [(d, t, "en", "src0", len(t or ""), 7, "x") for d, t in rows]
        names = "doc_id long, text string, lang string, source string, n_chars long, length long, score string"
        return spark.createDataFrame(full, names)

    return make
