import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, node string"

#: Nulls in any column, empty and blank texts, a repeated row, a repeated doc_id, a very long text; `row` and `node` clash with inner names.
LONG = "\n".join(f"line {k} of a very long text with word{k % 7} and more words after it" for k in range(3000))
ODD = [
    (1, "one two three four five six", "en", "a", 27, "r", "n"),
    (2, None, None, None, None, None, None),
    (3, "", "en", "a", 0, "r", "n"),
    (4, " \t\n ", "en", "b", 4, "r", "n"),
    (5, "one two  three\nfour five six", "en", "b", 28, "r", "n"),
    (5, "one two  three\nfour five six", "en", "b", 28, "r", "n"),
    (None, "one two three four five six", "en", "a", 27, "r", "n"),
    (6, LONG, "en", "c", len(LONG), "r", "n"),
    (7, LONG + " tail", "en", None, len(LONG) + 5, "r", "n"),
    (8, "hi", "en", "c", 2, "r", "n"),
    (9, "HI", "en", "c", 2, "r", "n"),
]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """The table above, read from files, as operators find it."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(ODD, DOCS).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(path)
    return spark.read.parquet(path)
