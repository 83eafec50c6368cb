import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from texts; some extra columns have names that operators use inside."""

    def make(texts, langs=None, parts=3):
        rows = [(i, t, langs[i] if langs else "en", f"s{i % 3}", i) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, DOCS).repartition(parts)
        return df.selectExpr("*", "'x' as id", "1 as n", "'y' as label", "0 as shard", "null as rep")

    return make
