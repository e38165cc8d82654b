import pytest


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra and clashing columns."""
    long = " ".join(f"word{i % 977} filler" for i in range(30_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog", "en", "a", 43, 7),
        (2, "the quick  brown fox jumps over the lazy dog", "en", "a", 44, 7),
        (2, "the quick  brown fox jumps over the lazy dog", "en", "a", 44, 7),
        (3, None, None, None, None, None),
        (4, "", "en", "b", 0, 1),
        (None, "a row without an id but with words", "en", None, 34, 2),
        (None, None, None, None, None, None),
        (5, "!!! ... ???", "de", "b", 11, 3),
        (6, long, "en", "a", len(long), 4),
        (7, "naïve café — “ünïcode” 😀 text", "fr", "a", 30, 5),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, cell long")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
