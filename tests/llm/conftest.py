import pytest

TABLES = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark, docs_schema):
    """documents rows from (doc_id, text) pairs."""

    def make(rows, lang="en"):
        return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t in rows], docs_schema)

    return make
