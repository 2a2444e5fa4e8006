import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, row string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, clashing extra columns."""
    long_text = " ".join(f"word{i % 997} tail{i}" for i in range(20_000))
    rows = [
        (1, "the cat sat on the mat and looked at the dog", "en", "a", 44, 0.5, "x"),
        (1, "the cat sat on the mat and looked at the dog", "en", "a", 44, 0.5, "x"),
        (2, "The CAT sat on the mat and looked at the dog", "en", "a", 44, 0.5, "x"),
        (3, None, None, None, None, None, None),
        (4, "", "en", "a", 0, 0.1, "y"),
        (5, " \t\n\x0b ", "en", "b", 5, 0.1, "y"),
        (6, "single", "en", "b", 6, 0.1, "y"),
        (None, "a text without an id, quite short", "en", "b", 33, 0.1, "y"),
        (7, long_text, "en", "c", len(long_text), 0.1, "y"),
        (8, "schön élan 日本 🙂 \x00 ▁mark  two  spaces ", "de", "c", 30, 0.1, "y"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
