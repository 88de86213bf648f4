"""Every registered query equals its DuckDB statement (order-insensitive, exact values)."""

from __future__ import annotations

import os
import sys

import pytest

import __spark_entry__ as entry
from listenlab.registry import QUERIES

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle_compare import compare, duck  # noqa: E402

KEYS = list(QUERIES)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def results(spark, sf_small):
    return compare(spark, sf_small, KEYS, con=duck(sf_small))


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(results, key):
    assert results[key][0] == "ok", results[key]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["location", "year", "month", "month_name", "subscription", "total_duration"]
    assert df.count() > 0
