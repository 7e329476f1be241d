import pytest


def docs_frame(spark, rows):
    """Rows (doc_id, text) with the other columns of documents and one whose name clashes with helpers' columns."""
    full = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, block string")


@pytest.fixture
def make_docs(spark):
    return lambda rows: docs_frame(spark, rows)
