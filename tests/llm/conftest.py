import pytest


@pytest.fixture(scope="session")
def small():
    """The tables on which queries are compared with SQL."""
    return "/root/testdata/sf0.01"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) tuples; nulls allowed everywhere."""

    def build(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(full, schema)

    return build
