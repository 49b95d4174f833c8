"""Fixtures of the tests of the training-data operators."""

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, row string, tie string, nth int"
LONG = " ".join(f"word{i % 977} Ünï{i}" for i in range(20_000))
ROWS = [(1, "The quick brown fox jumps over the lazy dog.", "en", "a"), (2, "The quick brown fox jumps over the lazy dog.", "en", "a"),
        (3, None, None, None), (4, "", "en", "b"), (5, " \t\n ", None, "b"), (6, LONG, "de", None),
        (7, "eins", "de", "c"), (7, "eins", "de", "c"), (8, "日本語のテキスト", "ja", "😀"), (9, "a\x1cb <|endoftext|> c  d", "en", "c"),
        (None, "no id here", "en", "a"), (10, "the quick brown fox jumps over the lazy dog", "en", "b")]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with names used inside."""
    return spark.createDataFrame([(*r, "r", "t", 1) for r in ROWS], DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(12)] + [(None, 1, 1), (3, None, None)],
                                 "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")



SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    """Documents and labels of the smallest test tables."""
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache(), spark.read.parquet(f"{SMALL}/labels.parquet")
