"""Cases and fixtures of the training-data operator tests."""

import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, kept boolean, slot long, words string"

LONG = " ".join(f"w{i % 977}" for i in range(30_000))
# NULLs in any column, empty and very long texts, ties, repeated rows, clashing names
NASTY = [
    (1, None, "en", "a", 0, 7, False, 3, "x"),
    (2, "", None, None, None, None, None, None, None),
    (None, "one two three four five six", "en", "b", 3, 1, True, 1, "y"),
    (3, " \t\n\x0b\x0c\r ", "en", "b", 3, 1, True, 1, "y"),
    (4, LONG, "en", "a", 3, 1, True, 1, "y"),
    (5, "Same text here, again and again.\n" * 40, "en", "a", 3, 1, True, 1, "y"),
    (6, "Same text here, again and again.\n" * 40, "en", "a", 3, 1, True, 1, "y"),
    (6, "Same text here, again and again.\n" * 40, "en", "a", 3, 1, True, 1, "y"),
    (7, "été \U0001f600 日本語 <|endoftext|> İΣ\x1c x\x85y z", "fr", "c", 3, 1, True, 1, "y"),
    (8, "a b c d e f g h a b c d e f g h i", "en", "c", 3, 1, True, 1, "y"),
    (9, "word", "en", "c", 3, 1, True, 1, "y"),
    (10, "x x x x x x x x x x x x x x x x x x x x x x x x", "en", "c", 3, 1, True, 1, "y"),
]


@pytest.fixture(scope="session")
def nasty(spark):
    return spark.createDataFrame(NASTY, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def key(row):
    return repr(tuple(row))
