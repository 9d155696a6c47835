import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, component string, size long, hash string, row long"


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and blank texts, a long text, ties, repeated rows, and columns whose names operators use."""
    def row(i, text, lang="en", source="s"):
        return (i, text, lang, source, None if text is None else len(text), "x", "y", 1, "z", 7)

    words = " ".join(f"word{i % 97}x{i}" for i in range(20_000))
    rows = [row(1, None), row(2, ""), row(3, " \n\t "), row(4, "one"), row(5, "one"), row(5, "one"), row(None, "one two three four"),
            row(6, words), row(7, words), row(8, "A b C d E f", None, None), row(9, "password=abcdef12345 at a@b.example", "de", None)]
    return spark.createDataFrame(rows, SCHEMA)
