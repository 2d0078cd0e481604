import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_helpers import LONG, prose  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties,
    and extra columns whose names the operators use themselves."""
    base = prose(1, 60)
    rows = [(1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, base + " tail of words", "en", "b"),
            (4, prose(2, 80), None, "b"), (5, "", "en", None), (6, None, "en", "a"), (7, LONG, "en", "c"),
            (8, "one two three", "en", "c"), (9, "ONE\ttwo\nthree", "en", "c"), (10, "   ", "en", "c"),
            (11, "one two three four", "en", "c"), (12, prose(2, 80), "en", "b"), (12, prose(2, 80), "en", "b"),
            (None, base, None, None), (13, "été à la plage \U0001F600 öl", "fr", "Z"), (14, "1234 5678 !!", None, "a")]
    rows = [(*r, 5, "x", 0.5, "keep") for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "size int, shard string, score double, blocks string")


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
