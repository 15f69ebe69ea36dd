import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, source) rows."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows], DOC)
    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    from pyspark.sql import functions as F

    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, None, None), (None, "a b c d e f g", "x"), (None, None, None),
            (3, "", "y"), (4, "   \n\t ", "y"), (5, "w" * 200_000, "y"), (6, "the cat sat on the mat " * 20_000, "z"),
            (7, "ünï 𐍈 日本 😀 \x1c\x85", "z"), (8, "one", "z")]
    df = make_docs(rows)
    for name in ("ids", "fingerprint", "shard", "slot", "row", "row_key", "toxicity", "t", "w", "h", "times", "size", "key"):
        df = df.withColumn(name, F.lit(7))
    return df
