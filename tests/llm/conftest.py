"""Small documents with every awkward case, and helpers to compare results."""

import pytest

PHRASES = ["the quick brown fox jumps over the lazy dog and runs", "a short line", "und der Mond scheint hell auf die Felder hinaus"]


def edge_rows():
    long_text = " ".join(f"word{i % 997}" for i in range(30_000))
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "x", "en", "b", 1), (4, " \t\n\r\x0b\x0c ", None, None, 7),
        (5, long_text, "en", "b", len(long_text)), (6, "e" * 20_000, "de", "c", 20_000),
        (7, PHRASES[0] * 3, "en", "a", 1), (8, PHRASES[0] * 3, "en", "c", 1), (8, PHRASES[0] * 3, "en", "c", 1),
        (None, PHRASES[2], "de", "b", 5), (None, PHRASES[2], "de", "b", 5), (9, "a b▁c \U0001f600 é", "fr", "ä", 9),
        (10, "mail me at jo.doe@example.com or +1 (736) 555-2678, 10.0.0.1 and 4111 1111 1111 1111.", "en", "z", 80),
    ]
    return [(*r, "clash", i) for i, r in enumerate(rows)]


EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, size int"


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), EDGE_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 0, 1), (5, 1, 0), (5, 1, None), (None, 1, 1), (99, None, 0)],
                                 "doc_id long, quality int, toxic int")
