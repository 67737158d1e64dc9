"""Tables shared by the tests of this folder."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"

#: Column names that outputs and intermediate steps of the operators use.
CLASHES = ["size", "SHARD", "slot", "row", "id", "n", "key", "text_crc32", "score", "n_words", "items", "copies", "no", "salt", "tokens", "a.b"]


def long_text(words=120_000):
    return " ".join(f"w{i * i % 9973}" for i in range(words))


def edge_rows():
    """(doc_id, text, source): nulls, empties, blanks, ties, repeated rows and a very long text."""
    return [
        (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "one two three four five six seven", "b"),
        (5, "One TWO three four five six seven", "b"), (6, "one two three four five six seven", None), (6, "one two three four five six seven", None),
        (7, "short", "a"), (8, "short", "a"), (9, "Short", "c"), (10, "ÄÖ ß é 日本語 w w w w w w", "c"), (11, "äö ß é 日本語 w w w w w w", "c"),
        (12, long_text(), "b"), (13, "x" * 400_000, "a"), (None, "a row without an id", "a"), (14, "", None), (15, None, None),
    ]


def make_docs(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHES})
    return df


@pytest.fixture(scope="session")
def edge_docs(spark):
    return make_docs(spark, edge_rows())


@pytest.fixture(scope="session")
def clashing_docs(spark):
    return make_docs(spark, edge_rows(), extra=True)


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])
