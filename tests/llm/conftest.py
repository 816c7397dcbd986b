import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty, wordless and long texts, ties, repeated rows, clashing extra columns."""
    rnd = random.Random(5)
    long = " ".join(f"word{rnd.randrange(3000)}" for _ in range(30_000))
    same = " ".join(f"same{i}" for i in range(60))
    rows = [
        (None, None, None, None, None), (None, "no id " * 40, None, None, 1), (1, None, "en", None, 0), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4),
        (4, "one two", "en", "s", 7), (5, same, "en", "s", 1), (6, same, "fr", "s", 1), (7, same + " tail", "en", "s", 1), (8, same, "en", "s", 1), (8, same, "en", "s", 1),
        (9, long, "en", "s", 1), (10, "é😀ü " * 50, "de", "s", 1), (11, "a" * 5000, "en", "s", 1), (12, "<|im_end|> <|endoftext|> ▁x", "en", "s", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in ("g", "kept", "score", "class", "row", "part", "n_words", "shard")}).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
