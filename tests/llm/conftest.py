import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, h long, row string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, source]) rows, with extra columns whose names clash with internal ones."""

    def build(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else None, 3, 7, 9, "x") for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return build
