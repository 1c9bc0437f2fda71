import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, topic int, kept string, v int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, further columns with clashing names."""
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
    rows = [
        (1, "The same text, twice over and again.", "en", "a"),
        (2, "The same text, twice over and again.", "en", "a"),
        (2, "The same text, twice over and again.", "en", "a"),
        (3, "THE SAME text, twice over and again.", "de", "b"),
        (None, "The same text, twice over and again.", None, None),
        (None, None, None, None),
        (4, None, "en", "a"),
        (5, "", "en", None),
        (6, "", None, "b"),
        (7, "... !!! 123 \n\t ", "fr", "b"),
        (8, long, "en", "a"),
        (9, long + " more", "en", "a"),
        (10, "one two", "en", "c"),
        (11, "İstanbul straße 東京 \u0000 x\U0001d400", "de", "c"),
    ]
    return spark.createDataFrame([(*r, 0, "s", 1, "k", 2) for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
