"""Listens per US state for an artist, with every one of the 51 states present.

The state dimension is a 51-element constant, so no join is needed: each
artist's per-state counts are folded into a map of at most 51 entries, then
read back once per state of the constant (explode for the map table, array
reductions for the statistics). Codes outside the 51 states drop out, states
with no listens get 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.pre_aggregated import listens_of
from ..sources.schema import STATE_CODES, state_codes_sql, us_states_sql

# The expressions below are SQL text: the 51-state constant and the lambdas
# over it parse in one call each. `m` names the state -> listens map column.
_IN_STATES = f"state IN ({state_codes_sql()})"
_MAP_AGG = f"map_from_entries(collect_list(CASE WHEN {_IN_STATES} THEN struct(state, listens) END))"
_GRID = (
    f"transform({us_states_sql()}, s -> named_struct('position', s.position, 'NAME', s.NAME, "
    "'state', s.state, 'listens', coalesce(try_element_at(m, s.state), CAST(0 AS BIGINT))))"
)
# One pass over the grid, bound once: total, and the max / min rows with ties
# going to the earlier state in dimension order.
_STATS = (
    f"element_at(transform(array({_GRID}), g -> named_struct("
    "'total', aggregate(g, CAST(0 AS BIGINT), (acc, x) -> acc + x.listens), "
    "'top', array_max(transform(g, x -> named_struct('l', x.listens, 'p', -x.position, 's', x.state))), "
    "'low', array_min(transform(g, x -> named_struct('l', x.listens, 'p', x.position, 's', x.state))))), 1)"
)


def _state_counts_map() -> Column:
    """Aggregate expression: map state -> listens over rows `(state, listens)` inside the 51 states."""
    return F.expr(_MAP_AGG)


def _explode_grid(per_artist: DataFrame, artist: Column) -> DataFrame:
    return per_artist.select(artist.alias("artist"), F.inline(F.expr(_GRID))).select(
        "artist", "state", "listens", "NAME", "position"
    )


def state_map(df: DataFrame, artist: str) -> DataFrame:
    """51 rows `artist, state, listens, NAME, position` for one artist, in dimension order.

    A global aggregate always yields one row, so an artist with no listens
    still gets 51 zero rows; the name comes from the parameter.
    """
    counts = (
        df.where((F.col("artist") == F.lit(artist)) & F.expr(_IN_STATES))
        .groupBy("state")
        .agg(listens_of(df).alias("listens"))
    )
    per_artist = counts.agg(_state_counts_map().alias("m"))
    # The global aggregate is a single partition, so sorting within it is a
    # total order without a range-partitioning job.
    return _explode_grid(per_artist, F.lit(artist)).sortWithinPartitions("position")


def _per_artist_maps(df: DataFrame) -> DataFrame:
    """One row per non-NULL artist: `m` (state -> listens within the 51) and `nationwide_listens`."""
    counts = (
        df.where(F.col("artist").isNotNull())
        .groupBy("artist", "state")
        .agg(listens_of(df).alias("listens"))
    )
    return counts.groupBy("artist").agg(
        _state_counts_map().alias("m"), F.sum("listens").alias("nationwide_listens")
    )


def state_map_all(df: DataFrame) -> DataFrame:
    """`state_map` for every (non-NULL) artist: artists x 51 rows."""
    return _explode_grid(_per_artist_maps(df), F.col("artist"))


def _with_stats(per_artist: DataFrame) -> DataFrame:
    """Statistics of each row's map `m` (rows also carry `artist`, `nationwide_listens`).

    The grid reduction is bound to one column first, so it runs once per row.
    """
    st = F.col("_st")
    return per_artist.select("artist", "nationwide_listens", F.expr(_STATS).alias("_st")).select(
        "artist",
        "nationwide_listens",
        st["total"].alias("total_listens"),
        (st["total"].cast("double") / F.lit(float(len(STATE_CODES)))).alias("avg_listens"),
        st["top"]["s"].alias("top_state"),
        st["top"]["l"].alias("top_listens"),
        st["low"]["s"].alias("low_state"),
        st["low"]["l"].alias("low_listens"),
    )


def map_stats(df: DataFrame, artist: str) -> DataFrame:
    """Statistics of one artist's 51-state map: one row."""
    counts = (
        df.where(F.col("artist") == F.lit(artist))
        .groupBy("state")
        .agg(listens_of(df).alias("listens"))
    )
    per_artist = counts.agg(
        _state_counts_map().alias("m"),
        F.coalesce(F.sum("listens"), F.lit(0).cast("bigint")).alias("nationwide_listens"),
    )
    return _with_stats(per_artist.select(F.lit(artist).alias("artist"), "nationwide_listens", "m"))


def map_stats_all(df: DataFrame) -> DataFrame:
    """Map statistics for every (non-NULL) artist, without materialising the 51-row grid.

    `total_listens` sums the 51 states; `nationwide_listens` also counts listens
    with a NULL state or a code outside the 51.
    """
    return _with_stats(_per_artist_maps(df))
