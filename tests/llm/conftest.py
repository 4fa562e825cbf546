import pytest

LONG = "lorem ipsum dolor sit amet consetetur " * 4000


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, extra columns with clashing names."""
    a = "The quick brown fox jumps over the lazy dog while seven wizards mix a potion of odd herbs for a friend."
    rows = [(1, a, "en", "s", 3, "x"), (1, a, "en", "s", 3, "x"), (2, "", "en", "s", 0, "x"), (3, None, None, None, None, None),
            (None, a + " tail", "en", None, 1, "y"), (4, LONG, "en", "s", 9, "z"), (5, "one two", None, "s", 7, "q"),
            (6, "  \n\t ", "en", "s", 5, "q"), (7, a.replace("seven", "eight"), "en", "s", 3, "x"),
            (8, "É\u0301tude caf\u00e9 \U0001f600 \x1codd <|endoftext|> don't 1234 ..", "fr", "s", 3, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string").coalesce(2)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")
