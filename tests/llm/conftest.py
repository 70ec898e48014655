import pytest


@pytest.fixture
def documents(spark):
    """(rows) -> frame with the columns of documents; doc_id and text given, the rest filled in."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long")
    return make
