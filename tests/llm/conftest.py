import pytest


@pytest.fixture
def docs(spark):
    """Make a documents table from (id, text[, lang]) rows."""
    def build(rows, extra=""):
        full = [(*r, None)[:3] if len(r) == 2 else r for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string")
    return build
