import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"word{n % 5000} tail{n}" for n in range(60_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, rate string, entities string, text_hash int"
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (3, "", "en", "a"),
    (4, None, None, None),
    (5, "   \t\n ", "en", None),
    (6, "one", None, "b"),
    (7, LONG, "en", "b"),
    (7, LONG, "en", "b"),
    (8, "Ünïcödé çà et là, naïve façade — 東京 и Москва 🙂🙂", "fr", "b"),
    (None, "a row without an id stays a row", "en", "c"),
    (9, "mail me at jane.roe@example.org or call +1 (212) 555-0188 now", "en", "c"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names clash with operators' own."""
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, 1, "x", "y", 2) for r in ROWS], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
