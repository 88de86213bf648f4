from __future__ import annotations

import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

#: As in the conftest above: when the whole suite is collected, `conftest` is this module for the tests there too.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

LONG = "lorem ipsum dolor sit amet " * 20_000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, and columns that the operators use themselves."""
    names = "score double, predicted int, n_tokens long, token_ids array<int>, size long, target double, taken long, shard int, slot long, fp long, `group` long, component_id long, n_lines long, key long"
    nothing = (None,) * 14
    rows = [
        (1, "a b c d e", "en", "x", 9),
        (1, "a b c d e", "en", "x", 9),
        (2, "", "en", "x", 0),
        (3, None, None, None, None),
        (None, "a b c d e", "en", "y", 9),
        (None, None, None, None, None),
        (4, " \t\n ", "en", "y", 4),
        (5, LONG, "en", "y", len(LONG)),
        (6, "idiot", "en", None, 5),
        (7, "É\x85ß \U0001f600", "de", "z", 5),
    ]
    return spark.createDataFrame([r + nothing for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {names}")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
