import pytest

SF = "/root/testdata/sf0.001"

#: Null, empty, spaces only, repeated rows and texts, odd characters, special
#: strings, one long run, a null id, an id that is given twice with other texts.
EDGE_ROWS = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "one two three"), (4, "one two three"), (5, "one two three"),
    (6, "don't  I'll\n\n é日本 ́x <|endoftext|> y<|startoftext|>"), (7, "a" * 5000), (None, "null id"),
    (8, "x y z " * 4000), (9, "first text"), (9, "other text"), (10, "\x85 \x1c İΣ ß\r\n end"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Columns that clash with those the operators make are there too."""
    rows = [(i, t, "en", "src", -1, "ids", -5) for i, t in EDGE_ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string, start int")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
