"""Listen counts: per artist and state, artist lists, top and bottom artists, top songs.

Every count is a hash aggregate with a map-side partial step, so a hot key
(one artist or state holding much of the data) is collapsed inside each map
task before the shuffle. Top-k cuts are deterministic: ties go to the key in
ascending order with NULLs last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.locations import at_location, rollup_locations
from ..plans.pre_aggregated import listens_of
from ..plans.topk import by_count, top_k
from ..sources.schema import NATIONWIDE


def artist_state_listens(df: DataFrame, artist: str) -> DataFrame:
    """Listens by `(artist, state)` for one artist, most first.

    The artist filter is written on the input, so it reaches the scan and the
    aggregate only sees that artist's rows.
    """
    return (
        df.where(F.col("artist") == F.lit(artist))
        .groupBy("artist", "state")
        .agg(listens_of(df).alias("listens"))
        .orderBy(*by_count("listens", ["state"]))
    )


def artist_state_listens_all(df: DataFrame) -> DataFrame:
    """Listens by `(artist, state)` for every artist."""
    return df.groupBy("artist", "state").agg(listens_of(df).alias("listens"))


def artists_over(df: DataFrame, min_listens: int = 1000) -> DataFrame:
    """Artists with at least `min_listens` listens, most first (`artist, listens`)."""
    return (
        df.groupBy("artist")
        .agg(listens_of(df).alias("listens"))
        .where(F.col("listens") >= F.lit(min_listens))
        .orderBy(*by_count("listens", ["artist"]))
    )


def top_n_by_listens(df: DataFrame, n: int = 5, keys: list[str] | None = None) -> DataFrame:
    """The `n` rows with most `listens` of any frame having that column, numbered by `rank`."""
    keys = keys if keys is not None else [c for c in df.columns if c != "listens"]
    return top_k(df, n, by_count("listens", keys)).orderBy("rank")


def states_list(df: DataFrame) -> DataFrame:
    """Distinct states, sorted, NULL kept (last)."""
    return df.select("state").distinct().orderBy(F.asc_nulls_last("state"))


def _artist_output(df: DataFrame, *lead: str) -> DataFrame:
    return df.select(*lead, F.col("artist").alias("Artist"), "Total Streams", "rank")


def top_artists(df: DataFrame, location: str = NATIONWIDE, n: int = 10) -> DataFrame:
    """The `n` most-listened artists of one location (`Artist, Total Streams, rank`)."""
    counts = at_location(df, location).groupBy("artist").agg(listens_of(df).alias("Total Streams"))
    return _artist_output(top_k(counts, n, by_count("Total Streams", ["artist"]))).orderBy("rank")


def top_artists_all(df: DataFrame, n: int = 10) -> DataFrame:
    """`top_artists` for Nationwide and every state in one job (`location` column added)."""
    per_state = df.groupBy("state", "artist").agg(listens_of(df).alias("Total Streams"))
    by_loc = rollup_locations(per_state, ["artist"], ["Total Streams"])
    ranked = top_k(by_loc, n, by_count("Total Streams", ["artist"]), partition_by=["location"])
    return _artist_output(ranked, "location")


def bottom_artists(df: DataFrame, n: int = 3) -> DataFrame:
    """The `n` least-listened artists nationwide (`Artist, Total Streams, rank`)."""
    counts = df.groupBy("artist").agg(listens_of(df).alias("Total Streams"))
    return _artist_output(top_k(counts, n, by_count("Total Streams", ["artist"], ascending=True))).orderBy("rank")


def top_songs(df: DataFrame, subscription: str, location: str = NATIONWIDE, n: int = 5) -> DataFrame:
    """The `n` most-played songs among raw `subscription` listens, shown smallest first.

    Nationwide: `song, listens, rank`; for a state the `state` column leads.
    """
    rows = df.where(F.col("subscription") == F.lit(subscription))
    if location == NATIONWIDE:
        keys = ["song"]
    else:
        rows = at_location(rows, location)
        keys = ["state", "song"]
    counts = rows.groupBy(*keys).agg(listens_of(df).alias("listens"))
    return top_k(counts, n, by_count("listens", ["song"])).select(*keys, "listens", "rank").orderBy(F.desc("rank"))


def top_free_songs(df: DataFrame, location: str = NATIONWIDE, n: int = 5) -> DataFrame:
    return top_songs(df, "free", location, n)


def top_paid_songs(df: DataFrame, location: str = NATIONWIDE, n: int = 5) -> DataFrame:
    return top_songs(df, "paid", location, n)


def top_songs_all(df: DataFrame, n: int = 5, subscriptions: tuple[str, ...] = ("free", "paid")) -> DataFrame:
    """Top songs for every `(location, subscription)` in one job."""
    per_state = (
        df.where(F.col("subscription").isin(*subscriptions))
        .groupBy("state", "subscription", "song")
        .agg(listens_of(df).alias("listens"))
    )
    by_loc = rollup_locations(per_state, ["subscription", "song"], ["listens"])
    ranked = top_k(by_loc, n, by_count("listens", ["song"]), partition_by=["location", "subscription"])
    return ranked.select("location", "subscription", "song", "listens", "rank")
