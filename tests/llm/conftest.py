import pytest

D = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """make(texts): a documents table with ids from 0, or make([(id, text, source), ..])."""

    def run(items, schema=DOCS):
        rows = [x if isinstance(x, tuple) else (i, x, f"s{i % 3}") for i, x in enumerate(items)]
        return spark.createDataFrame([(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows], schema)

    return run


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{D}/documents.parquet")
