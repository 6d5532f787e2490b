import pytest

LONG = "lorem ipsum dolor sit amet, consectetur " * 6000
ODD_ROWS = [
    (1, None, "en", "a", None, "x", True),
    (2, "", None, None, 0, "x", None),
    (3, LONG, "en", "a", len(LONG), None, True),
    (4, "one two three", "de", "b", 13, "x", True),
    (4, "one two three", "de", "b", 13, "x", True),
    (None, "one two three", "de", "b", 13, "x", True),
    (None, None, None, None, None, None, None),
    (7, "\n\n \t\r\x0b\x0c", "fr", "b", 7, "x", True),
]


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, and names operators use."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string, kept boolean"
    return spark.createDataFrame(ODD_ROWS, schema)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.filter("doc_id = -99")
