import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) pairs with a source each."""

    def make(pairs, sources=None):
        rows = [(i, t, "en", (sources or ["a"])[n % len(sources or ["a"])], None) for n, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return make
