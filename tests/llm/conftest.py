import pytest


@pytest.fixture
def docs(spark):
    """Build documents (doc_id, text, source, lang, n_chars) from pairs or triples."""

    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "a", "en", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, source string, lang string, n_chars int")

    return make
