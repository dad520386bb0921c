import random

import pytest

WORDS = "ander the onin thes ed tion wh reat lys hand öst für été que ciónes mente".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(WORDS) for _ in range(r.randint(1, 3))) for _ in range(n))


#: Rows that every operator must bear: nulls, empty and very long texts, repeated rows, ties, odd white space.
EDGES = [
    (1, prose(1, 300), "en", "a"),
    (2, prose(1, 300), "en", "a"),
    (3, None, "de", "b"),
    (4, "", None, "b"),
    (5, " \t\n\x0b\x0c\r", "fr", None),
    (None, prose(2, 80), "en", "c"),
    (None, None, None, None),
    (7, prose(3, 60), "de", "c"),
    (7, prose(3, 60), "de", "c"),
    (7, prose(4, 60), "de", "c"),
    (8, "x" * 50_000, "en", "d"),
    (9, prose(5, 20_000), "es", "d"),
    (10, "one", "en", "a"),
    (11, "a b c \x1cd\x00e \U0001f600 ▁ <s></s> <|endoftext|>", "en", "a"),
    (12, "\n".join([prose(6, 8)] * 40), "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHES = ["_id", "_th", "size", "kept", "place", "copies", "spans", "ids", "quality", "score", "n_words", "n_removed", "kept_text", "class_id", "h1", "node", "n", "line", "_spans", "_found", "n_lines"]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, edges):
    """The same rows with columns whose names operators use."""
    from pyspark.sql import functions as F

    return edges.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
