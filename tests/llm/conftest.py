import pytest
from pyspark.sql import functions as F


@pytest.fixture
def messy(spark):
    """Documents with NULLs, empty, very long and repeated rows, and columns that clash with inner names."""
    long_text = " ".join(f"w{i % 997}" for i in range(40_000))
    rows = [
        (1, "plain words of a short text"), (2, None), (3, ""), (4, " \n\t "), (None, "no key here"), (None, None),
        (5, long_text), (6, "plain words of a short text"), (6, "plain words of a short text"), (7, "x" * 70_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clashing = ("key", "f", "h", "did", "th", "start", "n", "score", "kept", "words", "fingerprint", "ids", "_text2")
    return docs.select("*", *[F.lit("mine").alias(c) for c in clashing])


@pytest.fixture
def nothing(messy):
    return messy.filter("false")
