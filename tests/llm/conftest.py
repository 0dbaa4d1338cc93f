import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, fp string, start int"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows like ``documents`` with extra columns whose names clash with the operators' own."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, "x", 1) for i, t in rows], DOCS)

    return make
