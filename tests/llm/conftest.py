import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long, score double, kept int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows that break careless code: NULLs in any column, empty and blank texts, one very
    long text, repeated rows, an id with two texts, and columns that clash with results."""
    words = " ".join(f"word{i % 700}x{i}" for i in range(30_000))
    plain = ("the quick brown fox jumps over the lazy dog and runs far away from here "
             "until night falls on the quiet town by the river bank")
    rows = [
        (1, plain, "en", "a"), (1, plain, "en", "a"), (2, plain.upper(), "en", "a"),
        (3, None, "en", "b"), (4, "", "fr", None), (5, " \t\n\x0b\x0c\r ", None, "b"),
        (6, words, "de", "b"), (7, "one two", "de", None), (None, plain, "en", "a"),
        (None, None, None, None), (8, "one two", "de", "c"), (8, plain + " but not today", "en", "c"),
        (9, "nul\u00a0break \U0001f642 é\u0301 <|endoftext|> x  y\r\nz", "en", "c"),
    ]
    return spark.createDataFrame(
        [(*r, None if r[1] is None else len(r[1]), 0.5, 7) for r in rows], DDL)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
