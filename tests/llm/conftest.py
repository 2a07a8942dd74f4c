import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with those the operators use inside."""

    def make(rows):
        df = spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in rows], DOC)
        return df.selectExpr("*", "'x' as rep", "'x' as removed", "'x' as component", "1 as n", "2 as a", "'x' as cls")

    return make
