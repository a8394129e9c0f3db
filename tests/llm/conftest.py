import pytest


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text[, source]) as documents with extra columns, some of clashing names."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", "en", 1, "extra", 7) for r in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, source string, lang string, n_chars bigint, `shard` string, `score` int")

    return make
