"""Summary texts of small hand-worked tables: the literal text that each must give."""

from __future__ import annotations

import pytest

import listenlab as L

LISTENS = "userId long, artist string, song string, subscription string, state string, duration double, ts timestamp, year int, month int, month_name string"


def listens(spark, rows):
    """Rows of (user, artist, subscription, state, minutes, year, month, month name)."""
    return spark.createDataFrame(
        [(u, a, "song", sub, st, None if m is None else m * 60.0, None, y, mo, name) for u, a, sub, st, m, y, mo, name in rows], LISTENS
    )


MONTHS = [
    (1, "A", "free", "CA", 30.0, 2018, 10, "October"),
    (2, "A", "free", "CA", 45.5, 2018, 10, "October"),
    (2, "B", "paid", "NY", 24.5, 2018, 10, "October"),
    (1, "B", "free", "CA", 20.0, 2018, 11, "November"),
    (3, "B", "free", "NY", 50.0, 2019, 10, "October"),
]
UNDATED = [(9, "A", "free", "CA", 600.0, None, None, None)]


def test_monthly_summary(spark):
    d = listens(spark, MONTHS)
    got = {r.location: r.prompt for r in L.monthly_summary_prompt(L.monthly_seconds_all(d)).collect()}
    # User 2 paid once, so all of user 2's minutes are paid ones.
    assert got == {
        "Nationwide": "summarize: Total listening time is 170 minutes. Average monthly listening is 85 minutes. "
        "The peak month is October with 150 minutes. The lowest month is November with 20 minutes. "
        "In the peak month, listening breakdown is: free: 80, paid: 70.",
        "CA": "summarize: Total listening time is 96 minutes. Average monthly listening is 48 minutes. "
        "The peak month is October with 76 minutes. The lowest month is November with 20 minutes. "
        "In the peak month, listening breakdown is: free: 30, paid: 46.",
        "NY": "summarize: Total listening time is 74 minutes. Average monthly listening is 74 minutes. "
        "The peak month is October with 74 minutes. The lowest month is October with 74 minutes. "
        "In the peak month, listening breakdown is: free: 50, paid: 24.",
    }


@pytest.mark.parametrize(("ansi", "codegen"), [("true", "true"), ("true", "false"), ("false", "true"), ("false", "false")])
def test_undated_listens_have_no_month(spark, ansi, codegen):
    old = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.codegen.wholeStage")}
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    spark.conf.set("spark.sql.codegen.wholeStage", codegen)
    try:
        raw = [("1538173362000", 2.0), (None, 3.0), ("9000000000000000000", 4.0), ("10000000000000000", 5.0)]
        events = spark.createDataFrame(raw, "ts string, duration double")
        for c in L.LISTEN_SCHEMA.fieldNames():
            if c not in events.columns:
                events = events.selectExpr("*", f"cast(null as {L.LISTEN_SCHEMA[c].dataType.simpleString()}) as {c}")
        rows = {r.duration: (r.ts is None, r.year, r.month, r.month_name) for r in L.clean_listens(events).collect()}
        none = (True, None, None, None)
        assert rows == {2.0: (False, 2018, 9, "September"), 3.0: none, 4.0: none, 5.0: none}

        d = listens(spark, MONTHS + UNDATED)
        one = L.monthly_summary_prompt(L.monthly_seconds(d)).first()
        assert (one.peak_month, one.low_month, one.total_minutes, one.avg_month_minutes) == ("October", "November", 770.0, 85.0)
        months = [(r.month_name, r.total_duration) for r in L.monthly_listening(d, "CA").collect()]
        assert months == [(None, 600.0), ("October", 30.0), ("October", 45.5), ("November", 20.0)]
        text = {r.location: r.prompt for r in L.table_prompt(L.monthly_listening_all(d)).collect()}["CA"]
        assert "year=None, month=None, month_name=None, subscription=free, total_duration=600.00" in text
        assert "December" not in text
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_empty_texts(spark):
    d = listens(spark, [])
    empty = "No listening data is available for the selected filters."
    assert L.monthly_summary_prompt(L.monthly_seconds(d)).first().prompt == empty
    assert L.map_summary_prompt(L.map_stats(d, "Nobody"), "CA").first().prompt == empty
    assert L.bottom_artists_prompt(L.bottom_artists(d)).first().prompt == "No data is available for the selected filters."


COUNTS = [("A", "CA")] * 4 + [("A", "TX")] * 2 + [("A", None)] + [("A", "PR")] + [("B", "WY")] * 3 + [(None, "CA")] * 2


@pytest.fixture(scope="module")
def counted(spark):
    return spark.createDataFrame(COUNTS, "artist string, state string")


def test_map_summary(counted):
    got = {r.artist: r.prompt for r in L.map_summary_prompt(L.map_stats_all(counted), "CA").collect()}
    assert got == {
        "A": "summarize: Total listens Nationwide: 6.Total listens in CA: 6.Average listens in CA: 0."
        "Top state: CA with 4 listens.Lowest state: AL with 0 listens.",
        "B": "summarize: Total listens Nationwide: 3.Total listens in CA: 3.Average listens in CA: 0."
        "Top state: WY with 3 listens.Lowest state: AL with 0 listens.",
    }


def test_bottom_artists_and_cards(spark, counted):
    got = L.bottom_artists_prompt(L.bottom_artists(counted)).first().prompt
    assert got == "summarize concisely: The lowest 3 artists are: unknown, B, A with listens: 2, 3, 8. "
    figures = spark.createDataFrame([(2500, 150.0, 12_600_000.0), (1500, 90.0, 1.0)], "total_users long, avg_duration double, paid_duration double")
    cards = [(r.users_card, r.listening_card, r.paid_card) for r in L.kpi_cards(figures).collect()]
    assert cards == [("2k+", "2 MIN", "4k+ H"), ("2k+", "2 MIN", "0k+ H")]


def test_question_contexts(spark, counted):
    questions = spark.createDataFrame(
        [
            ("A", "Which state had the MOST listens?"),
            ("A", "And the least listens?"),
            ("A", "the top artist?"),
            ("B", "the bottom artist?"),
            ("A", "total listens?"),
            ("A", "Tell me."),
            ("Nobody", "total listens?"),
        ],
        "artist string, question string",
    )
    got = L.qa_context(L.artist_state_listens_all(counted), questions)
    assert {(r.artist, r.question): r.context for r in got.collect()} == {
        ("A", "Which state had the MOST listens?"): "In CA, A had 4 listens.",
        ("A", "And the least listens?"): "In PR, A had 1 listens.",
        ("A", "the top artist?"): "The top artist in CA is A with 4 listens.",
        ("B", "the bottom artist?"): "The bottom artist in WY is B with 3 listens.",
        ("A", "total listens?"): "The total listens across all states is 8.",
        ("A", "Tell me."): "In CA, A had 4 listens. In TX, A had 2 listens. In PR, A had 1 listens. In None, A had 1 listens.",
        ("Nobody", "total listens?"): "No data available to generate a summary.",
    }
