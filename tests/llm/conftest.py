import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Builds a documents table with a column more, whose name clashes with helpers."""
    def build(rows):
        full = [(i, t, *(rest or ("en", "src0"))) for i, t, *rest in rows]
        schema = DOCS + ", fingerprint string, rank int"
        return spark.createDataFrame([(i, t, lang, source, len(t or ""), "x", 1) for i, t, lang, source in full], schema)
    return build
