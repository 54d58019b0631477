import pytest

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, id string, doc string, rank int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and repeated rows, ties, a long text, columns named like results."""
    long_text = " ".join(f"w{i * 7919 % 5003}" for i in range(20000))
    rows = [
        (1, "one two three four five six seven", "en", "a", 33, 0.5, True, "x", "d", 1),
        (1, "one two three four five six seven", "en", "a", 33, 0.5, True, "x", "d", 1),
        (2, "one two three four five six seven", "en", None, 33, None, None, None, None, None),
        (3, " one  two three\nfour five six seven", None, "a", None, None, None, None, None, None),
        (4, "", "en", "b", 0, None, None, None, None, None),
        (5, None, None, "b", None, None, None, None, None, None),
        (None, "no id here at all", "en", "b", 17, None, None, None, None, None),
        (None, None, None, None, None, None, None, None, None, None),
        (6, " \t\n", "en", "c", 3, None, None, None, None, None),
        (7, long_text, "en", "b", len(long_text), None, None, None, None, None),
        (8, "ünï\x00 çödé 　 日本語 🙂 \x85 end", "xx", "c", 20, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, ODD_SCHEMA)
