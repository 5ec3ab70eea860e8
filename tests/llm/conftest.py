import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(words))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls everywhere, empty, blank and very long texts, ties, repeated rows, clashing column names."""
    long = prose(1, 60_000)
    rows = [
        (1, prose(2, 80), "en", "a", 1), (1, prose(2, 80), "en", "a", 1), (2, prose(2, 80), "de", None, None),
        (3, None, "en", "a", 0), (None, prose(3, 60), None, "b", 5), (None, None, None, None, None),
        (4, "", "en", "a", 0), (5, " \n\t ", "en", "a", 4), (6, long, "en", "a", len(long)), (7, long, "fr", "b", 2),
        (8, "one", "en", "a", 3), (9, "日本語 \U0001f600 é ​ x", "ja", "c", 9), (10, "a\n\na\nb\n" * 40, "en", "a", 3)]
    plain = spark.createDataFrame(rows, DOCS)
    clashing = ("fp", "mask", "kept", "text_key", "own_id", "component_id", "n_words", "shard", "_cell", "ids", "host", "item_id")
    from pyspark.sql import functions as F
    return plain.select("*", *[F.lit("x").alias(c) for c in clashing])


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
