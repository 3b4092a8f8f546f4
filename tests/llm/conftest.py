import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id string"


@pytest.fixture
def documents(spark):
    """Rows with nulls, empty and long texts, repeats, and extra columns with clashing names."""

    def make(texts, langs=None, sources=None):
        rows = [(i, t, langs[i] if langs else None, sources[i] if sources else f"s{i % 3}", len(t or ""), "k", "x") for i, t in enumerate(texts)]
        rows += [(None, None, None, None, None, None, None), (0, texts[0], langs[0] if langs else None, sources[0] if sources else "s0", 0, None, None)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
