import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h1 string, size string, r string, rank string"


@pytest.fixture
def docs(spark):
    """Rows with nulls in every column, empty and repeated ones, ties, and clashing column names."""

    def make(texts, ids=None, **columns):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, columns.get("lang", [None] * len(texts))[k], columns.get("source", [None] * len(texts))[k], None, "x", "y", None, "z") for k, (i, t) in enumerate(zip(ids, texts))]
        return spark.createDataFrame(rows, DOCS)

    return make
