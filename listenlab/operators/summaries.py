"""Summary statistics and the text built from them (the hand-off to a text model).

Each function turns a small aggregated table into one row per location (or
per artist) holding typed statistics and the ready text. The grouping inputs
are already aggregated, so every collect below is bounded by the calendar
(12 month names, a few subscriptions) or by the state list, never by the
number of listens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import coerce_numeric, py_fixed_sql, py_text

# --- fixed values -----------------------------------------------------------
EMPTY_MONTHLY = "No listening data is available for the selected filters."
EMPTY_BOTTOM = "No data is available for the selected filters."
EMPTY_TABLE = "No data available to generate a summary."
SUMMARIZE = "summarize: "
SUMMARIZE_CONCISELY = "summarize concisely: "
# monthly summary sentences
TOTAL_TIME = "Total listening time is {} minutes. "
AVERAGE_MONTH = "Average monthly listening is {} minutes. "
PEAK_MONTH = "The peak month is {} with {} minutes. "
LOW_MONTH = "The lowest month is {} with {} minutes. "
PEAK_BREAKDOWN = "In the peak month, listening breakdown is: {}."
# map summary sentences (no space after each full stop)
MAP_TOTAL_NATION = "Total listens Nationwide: {}."
MAP_TOTAL_IN = "Total listens in {}: {}."
MAP_AVERAGE_IN = "Average listens in {}: {}."
MAP_TOP = "Top state: {} with {} listens."
MAP_LOW = "Lowest state: {} with {} listens."
# bottom artists sentence (ends with a space)
BOTTOM_ARTISTS = "The lowest 3 artists are: {} with listens: {}. "
UNKNOWN_ARTIST = "unknown"
# question-answer contexts: keyword routes, tried in this order
QA_MOST = "most listens"
QA_LEAST = "least listens"
QA_TOP = "top artist"
QA_BOTTOM = "bottom artist"
QA_TOTAL = "total listens"
QA_STATE_SENTENCE = "In {}, {} had {} listens."
QA_TOP_SENTENCE = "The top artist in {} is {} with {} listens."
QA_BOTTOM_SENTENCE = "The bottom artist in {} is {} with {} listens."
QA_TOTAL_SENTENCE = "The total listens across all states is {}."
QA_NULL_STATE = "None"
DEFAULT_QUESTIONS = (
    "Which state had the most listens?",
    "Which state had the least listens?",
    "Who is the top artist in this state?",
    "Who is the bottom artist in this state?",
    "What are the total listens?",
    "Describe the table.",
)
# ---------------------------------------------------------------------------

# Wording of the table request is this library's own.
TABLE_PROMPT_HEAD = "Listening minutes per month and subscription, one row per line:\n"
TABLE_PROMPT_TAIL = "\nSummarize this data in two sentences or fewer."


def _fmt(template: str, *parts: Column) -> Column:
    """Fill `{}` slots of a fixed template with column values (NULL if any part is NULL)."""
    pieces = template.split("{}")
    out: list[Column] = []
    for i, text in enumerate(pieces):
        if text:
            out.append(F.lit(text))
        if i < len(parts):
            out.append(parts[i])
    return F.concat(*out)


def _number(df: DataFrame, name: str) -> Column:
    """The column as a double; text is coerced, unparsable values become NULL."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return coerce_numeric(F.col(name))
    return F.col(name).cast("double")


def _f0(name: str) -> Column:
    return py_text(name, 0)


def _group(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Grouped aggregate, or a global one (always one row) when there are no keys."""
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


# ----------------------------------------------------------------------------- monthly


def monthly_stats(monthly: DataFrame) -> DataFrame:
    """Statistics of a monthly table, per location (or one row when there is no `location`).

    Month totals merge years (grouped by month name only). Peak and lowest
    month ties go to the alphabetically first month. Missing values count as 0
    and a missing month name or subscription is left out of its grouping.
    With no `location` column the result is a single row, also for an empty
    input (`n_rows` = 0).

    Input: `monthly_seconds[_all]` output (a `seconds` column) or
    `monthly_listening[_all]` output (`total_duration` in minutes). With
    seconds, every total is a sum of seconds divided by 60 once at the end:
    exact for whole seconds and independent of summation order, so a total of
    exactly x.5 minutes stays x.5. Summing minute values that were already
    divided (the only choice for a minutes table) leaves the last bits to the
    order in which rows arrive.
    """
    loc = ["location"] if "location" in monthly.columns else []
    if "seconds" in monthly.columns:
        amount, scale = F.coalesce(F.col("seconds").cast("double"), F.lit(0.0)), 60.0
    else:
        amount, scale = F.coalesce(_number(monthly, "total_duration"), F.lit(0.0)), 1.0
    # `monthly_seconds_all` arrives partitioned by location, which serves the
    # three aggregates below (each groups by location plus finer keys).
    rows = monthly.select(*loc, "month_name", "subscription", amount.alias("amount"))
    by_sub = rows.groupBy(*loc, "month_name", "subscription").agg(
        F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n")
    )
    by_month = by_sub.groupBy(*loc, "month_name").agg(
        F.sum("amount").alias("amount"),
        F.sum("n").alias("n"),
        F.array_sort(
            F.collect_list(
                F.when(
                    F.col("subscription").isNotNull(),
                    F.struct("subscription", (F.col("amount") / F.lit(scale)).alias("minutes")),
                )
            )
        ).alias("breakdown"),
    )
    named = F.col("month_name").isNotNull()
    amount = F.col("amount")
    peak_key = F.when(named, F.struct((-amount).alias("m"), F.col("month_name").alias("k")))
    low_key = F.when(named, F.struct(amount.alias("m"), F.col("month_name").alias("k")))
    return _group(
        by_month,
        loc,
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n_rows"),
        (F.coalesce(F.sum(amount), F.lit(0.0)) / F.lit(scale)).alias("total_minutes"),
        (F.avg(F.when(named, amount)) / F.lit(scale)).alias("avg_month_minutes"),
        F.min_by("month_name", peak_key).alias("peak_month"),
        (F.max(F.when(named, amount)) / F.lit(scale)).alias("peak_minutes"),
        F.min_by("month_name", low_key).alias("low_month"),
        (F.min(F.when(named, amount)) / F.lit(scale)).alias("low_minutes"),
        F.min_by("breakdown", peak_key).alias("peak_breakdown"),
    )


def monthly_summary_prompt(monthly: DataFrame) -> DataFrame:
    """`monthly_stats` plus `prompt`: the five-sentence summary request, or the
    fixed sentence when the monthly table is empty."""
    s = monthly_stats(monthly)
    breakdown = F.expr(
        "array_join(transform(peak_breakdown, _bd -> "
        f"concat(_bd.subscription, ': ', {py_fixed_sql('_bd.minutes', 0)})), ', ')"
    )
    text = F.concat(
        F.lit(SUMMARIZE),
        _fmt(TOTAL_TIME, _f0("total_minutes")),
        _fmt(AVERAGE_MONTH, _f0("avg_month_minutes")),
        _fmt(PEAK_MONTH, F.col("peak_month"), _f0("peak_minutes")),
        _fmt(LOW_MONTH, F.col("low_month"), _f0("low_minutes")),
        _fmt(PEAK_BREAKDOWN, breakdown),
    )
    return s.withColumn(
        "prompt", F.when(F.col("n_rows") == 0, F.lit(EMPTY_MONTHLY)).otherwise(text)
    ).withColumn("peak_breakdown", breakdown)


def table_prompt(monthly: DataFrame) -> DataFrame:
    """The monthly table as text (one `col=value` line per row, in year, month,
    subscription order, a NULL subscription first as in the monthly table's own
    sort) wrapped in a request for a short summary; per location."""
    loc = ["location"] if "location" in monthly.columns else []
    if isinstance(monthly.schema["total_duration"].dataType, T.StringType):
        monthly = monthly.withColumn("total_duration", coerce_numeric(F.col("total_duration")))
    minutes_text = py_text("total_duration", 2)
    line = F.concat_ws(
        ", ",
        F.concat(F.lit("year="), F.coalesce(F.col("year").cast("string"), F.lit("None"))),
        F.concat(F.lit("month="), F.coalesce(F.col("month").cast("string"), F.lit("None"))),
        F.concat(F.lit("month_name="), F.coalesce(F.col("month_name"), F.lit("None"))),
        F.concat(F.lit("subscription="), F.coalesce(F.col("subscription"), F.lit("None"))),
        F.concat(F.lit("total_duration="), F.coalesce(minutes_text, F.lit("nan"))),
    )
    rows = monthly.select(
        *loc,
        F.struct(
            F.col("year").alias("y"), F.col("month").alias("m"),
            F.col("subscription").isNotNull().alias("sn"), F.col("subscription").alias("s"),
            line.alias("line"),
        ).alias("r"),
    )
    agg = _group(rows, loc, F.array_sort(F.collect_list("r")).alias("rows"))
    table = F.array_join(F.transform(F.col("rows"), lambda r: r["line"]), "\n")
    return agg.select(
        *loc,
        F.size("rows").alias("n_rows"),
        F.when(F.size("rows") == 0, F.lit(EMPTY_TABLE))
        .otherwise(F.concat(F.lit(TABLE_PROMPT_HEAD), table, F.lit(TABLE_PROMPT_TAIL)))
        .alias("prompt"),
    )


# ----------------------------------------------------------------------------- map


def map_summary_prompt(stats: DataFrame, label: str | Column) -> DataFrame:
    """Text from `map_stats[_all]`: five sentences about an artist's 51-state map.

    As in the dashboard, the "Nationwide" and "in <label>" totals both sum the
    51 states; `nationwide_listens` keeps the full count as a column. An artist
    without any listen gets the fixed sentence for empty data.
    """
    lab = F.lit(label) if isinstance(label, str) else label
    total = _f0("total_listens")
    text = F.concat(
        F.lit(SUMMARIZE),
        _fmt(MAP_TOTAL_NATION, total),
        _fmt(MAP_TOTAL_IN, lab, total),
        _fmt(MAP_AVERAGE_IN, lab, _f0("avg_listens")),
        _fmt(MAP_TOP, F.col("top_state"), _f0("top_listens")),
        _fmt(MAP_LOW, F.col("low_state"), _f0("low_listens")),
    )
    empty = F.coalesce(F.col("nationwide_listens"), F.lit(0)) == 0
    return stats.withColumn("label", lab).withColumn("prompt", F.when(empty, F.lit(EMPTY_MONTHLY)).otherwise(text))


# ----------------------------------------------------------------------------- bottom artists


def bottom_artists_prompt(bottom: DataFrame) -> DataFrame:
    """One row from `bottom_artists` output: names and counts in rank order.

    A NULL artist is written as "unknown"; no rows give the fixed sentence.
    """
    rows = bottom.agg(
        F.array_sort(F.collect_list(F.struct("rank", "Artist", "Total Streams"))).alias("rows")
    )
    names = F.array_join(F.transform(F.col("rows"), lambda r: F.coalesce(r["Artist"], F.lit(UNKNOWN_ARTIST))), ", ")
    counts = F.array_join(F.transform(F.col("rows"), lambda r: r["Total Streams"].cast("string")), ", ")
    text = F.concat(F.lit(SUMMARIZE_CONCISELY), _fmt(BOTTOM_ARTISTS, names, counts))
    return rows.select(
        F.size("rows").alias("n_artists"),
        names.alias("artists"),
        counts.alias("listens"),
        F.when(F.size("rows") == 0, F.lit(EMPTY_BOTTOM)).otherwise(text).alias("prompt"),
    )


# ----------------------------------------------------------------------------- question contexts


def qa_context(counts: DataFrame, questions: DataFrame | Sequence[str] = DEFAULT_QUESTIONS) -> DataFrame:
    """Question contexts over per-state counts (`artist, state, listens`), per artist.

    `questions` is a table (`artist, question`), joined to the artists' rows, or
    a list that is asked of every artist. Questions about an artist without
    listens get the fixed sentence as their context.

    For each artist and question the context sentence is chosen by the first
    keyword found in the lower-cased question; without one, every row becomes a
    sentence, in listens-descending order. Max/min ties go to the state first in
    ascending order (NULL last); a NULL state is written "None".
    """
    state = F.col("state")
    listens = F.col("listens")
    state_txt = F.coalesce(state, F.lit(QA_NULL_STATE))
    sentence = _fmt(QA_STATE_SENTENCE, state_txt, F.col("artist"), listens.cast("string"))
    row = F.struct(state_txt.alias("state"), listens.alias("listens"))
    per_artist = counts.where(F.col("artist").isNotNull()).groupBy("artist").agg(
        F.min_by(row, F.struct((-listens).alias("a"), state.isNull().alias("b"), state.alias("c"))).alias("mx"),
        F.min_by(row, F.struct(listens.alias("a"), state.isNull().alias("b"), state.alias("c"))).alias("mn"),
        F.sum(listens).alias("total"),
        F.array_sort(
            F.collect_list(
                F.struct((-listens).alias("a"), state.isNull().alias("b"), state.alias("c"), sentence.alias("s"))
            )
        ).alias("rows"),
    )
    q = F.col("question")
    lq = F.lower(q)
    artist = F.col("artist")
    mx, mn = F.col("mx"), F.col("mn")
    context = (
        F.when(lq.contains(QA_MOST), _fmt(QA_STATE_SENTENCE, mx["state"], artist, mx["listens"].cast("string")))
        .when(lq.contains(QA_LEAST), _fmt(QA_STATE_SENTENCE, mn["state"], artist, mn["listens"].cast("string")))
        .when(lq.contains(QA_TOP), _fmt(QA_TOP_SENTENCE, mx["state"], artist, mx["listens"].cast("string")))
        .when(lq.contains(QA_BOTTOM), _fmt(QA_BOTTOM_SENTENCE, mn["state"], artist, mn["listens"].cast("string")))
        .when(lq.contains(QA_TOTAL), _fmt(QA_TOTAL_SENTENCE, F.col("total").cast("string")))
        .otherwise(F.array_join(F.transform(F.col("rows"), lambda r: r["s"]), " "))
    )
    if isinstance(questions, DataFrame):
        asked = questions.select("artist", "question").join(per_artist, "artist", "left")
    else:
        asked = per_artist.withColumn("question", F.explode(F.array(*map(F.lit, questions))))
    context = F.when(F.col("total").isNull(), F.lit(EMPTY_TABLE)).otherwise(context)
    return asked.select("artist", "question", context.alias("context")).withColumn(
        "prompt", qa_prompt(F.col("context"), F.col("question"))
    )


def qa_prompt(context: Column, question: Column) -> Column:
    """`Table: <context>` / `Question: <question>` / `Answer:` on three lines."""
    return F.concat(F.lit("Table: "), context, F.lit("\nQuestion: "), question, F.lit("\nAnswer:"))
