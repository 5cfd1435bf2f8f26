import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of (doc_id, text, ...) as a table shaped like ``documents``, with a clashing extra column."""

    def make(rows, parts=3):
        full = [(i, t, "en", s, None if t is None else len(t), "x") for i, t, s in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, size string"
        return spark.createDataFrame(full, schema).repartition(parts)

    return make
