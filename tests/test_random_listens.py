"""Seeded random listens with hot keys and NULLs everywhere: the all-location forms equal
the single forms, and headline figures equal a direct Python computation."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import listenlab as L
from listenlab.sources.schema import CLEAN_COLUMNS

N = 3000
STATES = ["CA", "NY", "TX", "PR", None]
ARTISTS = ["Hot", "A", "B", "C", None]
SUBS = ["free", "paid", None]


def _rows(seed: int):
    rnd = random.Random(seed)
    out = []
    for i in range(N):
        hot = rnd.random() < 1 / 3
        user = 1 if hot else rnd.choice([2, 3, 4, 5, 6, None])
        artist = "Hot" if rnd.random() < 1 / 3 else rnd.choice(ARTISTS)
        year, month = rnd.choice([(2023, 11), (2023, 12), (2024, 1), (2024, 2)])
        row = dict.fromkeys(CLEAN_COLUMNS)
        row.update(
            userId=user, artist=artist, song=rnd.choice(["s1", "s2", "s3", None]),
            duration=rnd.choice([30.0, 60.0, 90.0, None]), subscription=rnd.choice(SUBS),
            state=rnd.choice(STATES), year=year, month=month,
            month_name={11: "November", 12: "December", 1: "January", 2: "February"}[month],
            sessionId=i,
        )
        out.append(row)
    return out


@pytest.fixture(scope="module")
def data(spark):
    rows = _rows(11)
    schema = (
        "userId long, lastName string, firstName string, gender string, song string, artist string, "
        "duration double, sessionId long, itemInSession int, auth string, subscription string, city string, "
        "state string, zip string, lat double, lon double, registration long, userAgent string, ts timestamp, "
        "year int, month int, month_name string"
    )
    df = spark.createDataFrame([tuple(r[c] for c in CLEAN_COLUMNS) for r in rows], schema)
    return rows, df


def _bag(frame, cols):
    return Counter(tuple(r[c] for c in cols) for r in frame.collect())


LOCS = ["Nationwide", "CA", "NY", "PR", "TX"]


def test_all_forms_equal_single_forms(data):
    _, df = data
    checks = [
        (L.top_artists_all(df), lambda loc: L.top_artists(df, loc), ["Artist", "Total Streams", "rank"]),
        (L.subscription_mix_all(df), lambda loc: L.subscription_mix(df, loc), ["subscription", "count", "percentage"]),
        (L.monthly_listening_all(df), lambda loc: L.monthly_listening(df, loc),
         ["year", "month", "month_name", "subscription", "total_duration"]),
    ]
    for allf, single, cols in checks:
        for loc in LOCS:
            assert _bag(single(loc), cols) == _bag(allf.where(F.col("location") == loc), cols), (cols, loc)


def test_headline_figures_against_python(data):
    rows, df = data
    k = L.kpis(df).collect()[0]
    users = {r["userId"] for r in rows}
    durs = [r["duration"] for r in rows if r["duration"] is not None]
    paid = [r["duration"] for r in rows if r["subscription"] == "paid" and r["duration"] is not None]
    assert k.total_users == len(users)
    assert k.avg_duration == pytest.approx(sum(durs) / len(durs))
    assert k.paid_duration == sum(paid)


def test_effective_subscription_against_python(data):
    rows, df = data
    ever_paid = {r["userId"] for r in rows if r["subscription"] == "paid" and r["userId"] is not None}
    expect = Counter(
        (r["sessionId"], "paid" if r["userId"] in ever_paid else r["subscription"]) for r in rows
    )
    got = _bag(L.effective_subscription(df), ["sessionId", "subscription"])
    assert got == expect
    # monthly minutes per effective subscription, nationwide
    m = Counter()
    for r in rows:
        eff = "paid" if r["userId"] in ever_paid else r["subscription"]
        m[(r["year"], r["month"], eff)] += r["duration"] or 0.0
    got_m = {(r.year, r.month, r.subscription): r.total_duration for r in L.monthly_listening(df).collect()}
    assert got_m == {k: v / 60 for k, v in m.items()}


def test_state_map_all_against_python(data):
    rows, df = data
    grid = {(r.artist, r.state): r.listens for r in L.state_map_all(df).collect()}
    c = Counter((r["artist"], r["state"]) for r in rows if r["artist"] is not None)
    artists = {r["artist"] for r in rows if r["artist"] is not None}
    assert len(grid) == 51 * len(artists)
    for (a, s), n in grid.items():
        assert n == c.get((a, s), 0), (a, s)
