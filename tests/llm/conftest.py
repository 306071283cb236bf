import pytest


@pytest.fixture(scope="session")
def tables(spark):
    """Small tables with the awkward rows: NULLs, empty texts, copies, ties, a long text, a clashing column."""
    long_text = " ".join(f"w{i % 977} x{i % 31}" for i in range(30_000))
    base = "The first line of the page has some words and the rest of it has more\nA second line with quite different content in it."
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, base.replace("second", "secund"), "en", "b"),
        (3, base.replace("second", "secund"), "en", "b"),
        (4, None, "en", None),
        (5, "", None, "b"),
        (6, " \t\n ", "de", "b"),
        (None, "only three words", "de", None),
        (7, long_text, "fr", "c"),
        (8, "tiny", "fr", "c"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumnsRenamed({})
