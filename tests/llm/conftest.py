import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents with extra columns whose names clash with the operators' own."""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, None, "s", None, 7, "x", 1, None) for i, t in zip(ids, texts)]
        return spark.createDataFrame(
            rows, DOCS + ", key long, fp string, length int, spans string"
        )

    return make


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
