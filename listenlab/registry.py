"""Registered queries: every operator as `(spark, sf_dir) -> DataFrame` over the driver's tables.

Listens are derived from the star-schema tables (`sources.tables`), raw events
go through `clean_listens`, and each key applies one operator to the whole
table. Parameters (an artist, a state) are the operator's own arguments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.numbers import coerce_numeric
from .functions.text import capitalize_sentences, mis_encode, repair_columns
from .operators import counts, kpis, maps, mix, monthly, subscriptions, summaries
from .operators.clean import clean_listens
from .plans.topk import by_count
from .sources import files
from .sources.schema import CLEAN_COLUMNS, NATIONWIDE
from .sources.tables import listen_events, listens, table

# Parameters of the single-selection queries.
ARTIST = "Brand#13"
STATE = "CA"
MIN_LISTENS = 1000
BRANDS = 25  # artists of the fixture; a threshold of the mean listens per artist keeps some and cuts some
MAP_LABEL = STATE


def _clean_listens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_listens(listen_events(spark, sf_dir)).select(*CLEAN_COLUMNS)


def _read_listens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events written as JSON lines to the shared folder, read back with the declared schema."""
    path = files.new_output_path(spark, "listen-events-json")
    files.write_listens(listen_events(spark, sf_dir), path)
    return files.read_listens(spark, path)


def _read_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned listens stored with `write_clean` (Parquet by year, month), read back with `read_clean`."""
    path = files.new_output_path(spark, "listens-clean")
    files.write_clean(listens(spark, sf_dir), path)
    return files.read_clean(spark, path)


def _effective_subscription(d: DataFrame) -> DataFrame:
    eff = subscriptions.effective_subscription(d)
    return eff.select("userId", "sessionId", "itemInSession", "state", "raw_subscription", "subscription")


def _ranked(df: DataFrame, *order: Column) -> DataFrame:
    """The operator's order as a column, since a comparison of rows doesn't see it; for small results."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def _artists_over_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = table(spark, sf_dir, "lineitem").count() // BRANDS  # from the file footers
    return _ranked(counts.artists_over(listens(spark, sf_dir), mean), *by_count("listens", ["artist"]))


def _monthly_stats(d: DataFrame) -> DataFrame:
    s = summaries.monthly_summary_prompt(monthly.monthly_seconds_all(d))
    return s.select(
        "location", "n_rows", "total_minutes", "avg_month_minutes",
        "peak_month", "peak_minutes", "low_month", "low_minutes", "peak_breakdown",
    )


def _monthly_summary_prompt(d: DataFrame) -> DataFrame:
    s = summaries.monthly_summary_prompt(monthly.monthly_seconds_all(d))
    return s.select("location", "n_rows", "prompt")


def _documents_layers(spark: SparkSession, sf_dir: str, layers: tuple[int, ...]) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    variants = F.array(
        *[F.struct(F.lit(n).alias("layers"), mis_encode(F.col("text"), n).alias("garbled")) for n in layers]
    )
    return docs.select("doc_id", F.inline(variants))


def _repair(mode: str, layers: tuple[int, ...]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        d = _documents_layers(spark, sf_dir, layers).withColumnRenamed("garbled", "text")
        return repair_columns(d, ["text"], mode).select("doc_id", "layers", "text")

    return run


def _capitalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", capitalize_sentences(F.col("text")).alias("text"))


def _coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    raw = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("event_id").cast("string"))
    return ev.select("event_id", raw.alias("raw"), coerce_numeric(raw).alias("value"))


def _on_listens(fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(listens(spark, sf_dir))

    return run


# Operators over cleaned listens: each a function DataFrame -> DataFrame, so the
# same key runs over listens derived from the driver tables (`QUERIES`) or over
# a stored clean table (`bench.py`).
LISTEN_OPERATORS: dict[str, Callable[[DataFrame], DataFrame]] = {
    # counts and top-k
    "artist_state_listens": lambda d: _ranked(counts.artist_state_listens(d, ARTIST), *by_count("listens", ["state"])),
    "artist_state_listens_all": counts.artist_state_listens_all,
    "artists_over": lambda d: counts.artists_over(d, MIN_LISTENS),
    "top_n_by_listens": lambda d: counts.top_n_by_listens(counts.artist_state_listens_all(d), 5),
    "states_list": lambda d: _ranked(counts.states_list(d), F.asc_nulls_last("state")),
    "top_artists": lambda d: counts.top_artists(d, NATIONWIDE),
    "top_artists_all": counts.top_artists_all,
    "bottom_artists": counts.bottom_artists,
    "top_songs_free": lambda d: counts.top_free_songs(d, STATE),
    "top_songs_paid": lambda d: counts.top_paid_songs(d, NATIONWIDE),
    "top_songs_all": counts.top_songs_all,
    # headline figures and mix
    "kpis": kpis.kpis,
    "kpi_cards": lambda d: kpis.kpi_cards(kpis.kpis(d)),
    "subscription_mix": lambda d: _ranked(mix.subscription_mix(d, STATE), *by_count("count", ["subscription"])),
    "subscription_mix_all": mix.subscription_mix_all,
    # effective subscription and monthly listening
    "effective_subscription": _effective_subscription,
    "monthly_listening": lambda d: _ranked(
        monthly.monthly_listening(d, STATE), F.col("year"), F.col("month"), F.col("subscription")
    ),
    "monthly_listening_all": monthly.monthly_listening_all,
    "monthly_stats": _monthly_stats,
    # state map
    "state_map": lambda d: maps.state_map(d, ARTIST),
    "state_map_all": maps.state_map_all,
    "map_stats": maps.map_stats_all,
    # summary text
    "monthly_summary_prompt": _monthly_summary_prompt,
    "map_summary_prompt": lambda d: summaries.map_summary_prompt(maps.map_stats_all(d), MAP_LABEL).select(
        "artist", "label", "prompt"
    ),
    "bottom_artists_prompt": lambda d: summaries.bottom_artists_prompt(counts.bottom_artists(d)),
    "qa_context": lambda d: summaries.qa_context(counts.artist_state_listens_all(d)),
    "table_prompt": lambda d: summaries.table_prompt(monthly.monthly_listening_all(d)),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources, sinks, cleaning
    "read_listens": _read_listens,
    "clean_listens": _clean_listens,
    "read_clean": _read_clean,
    "repair_text_compat": _repair("compat", (0, 1, 2)),
    "repair_text_strict": _repair("strict", (0, 1, 2)),
    "capitalize_sentences": _capitalize,
    "coerce_numeric": _coerce_numeric,
    # everything computed from listens
    **{k: _on_listens(fn) for k, fn in LISTEN_OPERATORS.items()},
    "artists_over": _artists_over_mean,
}

FLAGSHIP = "monthly_listening_all"
