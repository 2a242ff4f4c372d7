import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, rid int, fp string, digest string, "
          "size double, row string, label int, score string, copies string, batch string, block string")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and very long texts, repeated rows, columns with clashing names."""
    texts = [
        (1, "The cat sat on the mat, and it was happy there.", "en", "a"), (2, None, None, None), (3, "", "en", "b"),
        (4, " \t\n", "fr", None), (5, "word " * 60_000, "en", "a"), (5, "word " * 60_000, "en", "a"),
        (None, "no id here at all", "de", "c"), (None, None, None, None), (7, "12345 67890 !!", "es", "b"),
        (8, "The cat sat on the mat,  and it was happy there.", "en", "a"), (9, "é" * 5000 + "<|endoftext|> x", "fr", "d"),
        (10, "The cat sat on the mat, and it was happy there.", "en", None), (11, "x", None, "a"), (12, "\u0000   a b  c ", "de", "e"),
    ]
    return spark.createDataFrame([(i, t, l, s, None, 1, "f", "d", 0.5, "r", 3, "s", "c", "b", "k") for i, t, l, s in texts], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
