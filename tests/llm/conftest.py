import pytest


@pytest.fixture
def documents(spark):
    """A documents table from (id, text) pairs, with a column of every clashing kind."""

    def make(pairs, **extra):
        rows = [(i, t, "en", "s", len(t or "")) for i, t in pairs]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)

    return make
