import pytest
from llm_helpers import CLASHES, read
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, equal ids, and columns with clashing names."""
    rows = [
        (None, None, None), (None, "one two three four five six", "s1"), (1, None, None), (2, "", ""), (3, " \n\t ", "s1"),
        (4, "word", None), (5, "word", "s2"), (5, "word", "s2"), (6, "Ünï çode “quotes” 中文 😀 and more words", "s2"),
        (7, "long " * 40_000, "s1"), (8, "x" * 150_000, "s3"), (9, "a b c d e f g h i j k l m n", "s1"),
        (9, "another text of the same id that goes on and on", "s1"), (-3, "one two three four five six", "s1"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return frame.withColumns({"lang": F.lit(None).cast("string"), **{c: F.lit("taken") for c in CLASHES}})


@pytest.fixture(scope="session")
def empty_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def some_documents(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", "text", "source")
