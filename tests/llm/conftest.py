import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"wort{i % 977} x{i}" for i in range(6000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, other scripts."""
    rows = [
        (1, None, None, None, None), (None, "no id here at all, none", "en", "a", 23), (2, "", "en", "a", 0),
        (3, LONG, "en", "b", len(LONG)), (4, "same line of text here\nanother line of text here", "en", "b", None),
        (5, "same line of text here\nanother line of text there", "fr", None, 1), (5, "same line of text here\nanother line of text there", "fr", None, 1),
        (6, "漢字 и кириллица naïve É", None, "c", 9), (7, "   \n\t ", "en", "c", 6), (8, "12345 678", "de", "a", 9),
        (9, LONG, "en", "b", len(LONG)), (5, "other text under a repeated id", "en", "a", 30), (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def corpus(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")


def with_clashing_columns(docs):
    """Columns whose names the operators use inside."""
    for name in ("row", "_row", "hash", "_hash", "size", "set", "block", "score", "lang_pred", "_doc", "_dropped", "piece", "text_sha256", "kind", "at"):
        docs = docs.withColumn(name, docs["doc_id"])
    return docs
