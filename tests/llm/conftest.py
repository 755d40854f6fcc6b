"""Fixtures of the training-data operators' tests."""

import pytest
from odd_rows import LONG


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty texts, ties, repeated rows, a null id, a long text, and columns whose names clash with internal ones."""
    rows = [(1, "Alpha beta gamma delta epsilon", "en", "a"), (2, "ALPHA beta gamma delta epsilon", "en", "a"),
            (2, "ALPHA beta gamma delta epsilon", "en", "a"), (3, None, None, None), (4, "", "de", "b"), (5, "", "de", "b"),
            (6, " \t\n ", "fr", None), (7, LONG, "en", "a"), (None, "Alpha beta gamma delta epsilon", None, "b"),
            (None, None, None, None), (8, "ÄÖÜ ß é 日本語 🎉 <|endoftext|>", "de", "b"), (9, "x", "fr", "b")]
    return spark.createDataFrame([(*r, "clash", 0, 1, 2) for r in rows],
                                 "doc_id bigint, text string, lang string, source string, id string, fp int, salt int, norm int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("1 = 0")
