"""Rows that every operator must bear: nulls, empty and long texts, ties, repeats."""

import pytest
from pyspark.sql import functions as F

ODD = [
    (1, "The quick brown fox jumps over the lazy dog tonight", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog tonight", "en", "a"),
    (2, None, None, None),
    (None, "A text of no id is still a text", "en", None),
    (None, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n ", "de", "b"),
    (5, "word " * 30_000, "fr", "b"),
    (6, "x" * 100_000, None, "c"),
    (7, "Der schnelle Fuchs läuft über die Brücke 🙂\n\nund zurück", "de", "c"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with every oddity, and extra columns whose names operators use inside."""
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string, lang string, source string")
    clashing = "id fp label node row found place n_entities n_words score predicted kept _place"
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(
        "*", *[F.lit(i).alias(name) for i, name in enumerate(clashing.split())]
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def some_docs(spark):
    """The real documents of the smallest scale."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
