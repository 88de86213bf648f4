"""The all-locations (all-artists) forms, filtered to one selection, equal the single forms."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import listenlab as L
from listenlab.sources.tables import listens

LOCATIONS = ["Nationwide", "CA", "AL", "MN", "PR", "TX"]  # TX has no listens; PR is outside the map
ARTISTS = ["Brand#13", "Brand#1", "Brand#24"]


@pytest.fixture(scope="module")
def df(spark, sf_small):
    d = listens(spark, sf_small).cache()
    yield d
    d.unpersist()


def rows(frame, cols):
    return Counter(tuple(r[c] for c in cols) for r in frame.collect())


def at(frame, loc):
    return frame.where(F.col("location") == loc)


def test_top_artists(df):
    allf = L.top_artists_all(df)
    cols = ["Artist", "Total Streams", "rank"]
    for loc in LOCATIONS:
        assert rows(L.top_artists(df, loc), cols) == rows(at(allf, loc), cols), loc


def test_subscription_mix(df):
    allf = L.subscription_mix_all(df)
    cols = ["subscription", "count", "percentage", "percentage_text"]
    for loc in LOCATIONS:
        assert rows(L.subscription_mix(df, loc), cols) == rows(at(allf, loc), cols), loc


def test_top_songs(df):
    allf = L.top_songs_all(df)
    cols = ["song", "listens", "rank"]
    for loc in LOCATIONS:
        for sub in ("free", "paid"):
            single = L.top_songs(df, sub, loc)
            assert rows(single, cols) == rows(at(allf, loc).where(F.col("subscription") == sub), cols), (loc, sub)


def test_monthly(df):
    allf = L.monthly_listening_all(df)
    cols = ["year", "month", "month_name", "subscription", "total_duration"]
    for loc in LOCATIONS:
        assert rows(L.monthly_listening(df, loc), cols) == rows(at(allf, loc), cols), loc


def test_monthly_prompts(df):
    allp = L.monthly_summary_prompt(L.monthly_listening_all(df))
    allt = L.table_prompt(L.monthly_listening_all(df))
    for loc in LOCATIONS[:-1]:
        one = L.monthly_summary_prompt(L.monthly_listening(df, loc)).collect()
        assert [r.prompt for r in one] == [r.prompt for r in at(allp, loc).collect()], loc
        onet = L.table_prompt(L.monthly_listening(df, loc)).collect()
        assert [r.prompt for r in onet] == [r.prompt for r in at(allt, loc).collect()], loc


def test_state_map_and_stats(df):
    grid = L.state_map_all(df)
    stats = L.map_stats_all(df)
    cols = ["artist", "state", "listens", "NAME", "position"]
    for a in ARTISTS:
        assert rows(L.state_map(df, a), cols) == rows(grid.where(F.col("artist") == a), cols), a
        one = L.map_stats(df, a).collect()[0].asDict()
        many = stats.where(F.col("artist") == a).collect()[0].asDict()
        assert one == many, a


def test_qa_context_single_artist(df):
    qs = ["most listens", "least listens", "total listens", "describe"]
    allq = L.qa_context(L.artist_state_listens_all(df), qs)
    for a in ARTISTS:
        one = L.qa_context(L.artist_state_listens(df, a), qs)
        cols = ["artist", "question", "context", "prompt"]
        assert rows(one, cols) == rows(allq.where(F.col("artist") == a), cols), a


def test_artist_state_listens(df):
    allf = L.artist_state_listens_all(df)
    for a in ARTISTS:
        cols = ["artist", "state", "listens"]
        assert rows(L.artist_state_listens(df, a), cols) == rows(allf.where(F.col("artist") == a), cols)
