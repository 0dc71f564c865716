from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, id string, weight string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, columns with clashing names."""
    long_text = " ".join(f"word{i % 977} thing{i % 13}." for i in range(30_000))
    rows = [
        (1, "One two three four five six.", "en", "a", 28), (1, "One two three four five six.", "en", "a", 28),
        (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \t\n", None, "b", 3), (5, long_text, "de", "a", len(long_text)),
        (6, "12 34 !!", "fr", None, 8), (None, "A text without an id.", "en", "b", 21), (None, None, None, None, None),
        (7, "x", "es", "c", 1), (5, "other text of a repeated id", "de", "a", 27), (8, "naïve café – 漢字 😀", "fr", "c", 18),
    ]
    return spark.createDataFrame([(*r, "s", "t", "u", "v") for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
