import pytest

ODD_TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 3), (2, None), (3, ""), (4, "  \n\t "), (5, "one two"),
    (6, "The quick brown fox jumps over the lazy dog. " * 3), (7, "x" * 30_000), (8, "naïve café <|endoftext|> 日本 \x1c 😀"),
    (None, "a text without id"), (9, "word " * 5000), (10, "One Two"), (10, "One Two"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, blanks, very long and repeated texts, repeated rows, and columns with names that operators use."""
    rows = [(i, t, "id", "mark", "window", 0) for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, mark string, window string, hash int")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")
