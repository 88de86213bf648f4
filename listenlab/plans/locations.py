"""Location handling: one location, or every location in one job.

A location is either "Nationwide" (all listens, including those with a NULL
state) or a state code (listens with that state).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schema import NATIONWIDE


def at_location(df: DataFrame, location: str) -> DataFrame:
    """Listens of one location; a plain filter that Catalyst pushes to the scan."""
    if location == NATIONWIDE:
        return df
    return df.where(F.col("state") == F.lit(location))


def rollup_locations(
    per_state: DataFrame, keys: Sequence[str], additive: Sequence[str], by_location: bool = False
) -> DataFrame:
    """Turn an aggregate keyed by `("state", *keys)` into one keyed by `("location", *keys)`.

    Each non-NULL state becomes its own location; "Nationwide" is re-aggregated
    from the same per-state results (so NULL states count there). The measures
    must be additive (counts, sums).

    Each per-state row is emitted twice, under its state and under
    "Nationwide", and the copies are summed by location. The raw rows are
    therefore aggregated once (a GROUPING SETS plan would expand every raw row
    before the partial aggregate), and the second aggregate only sees the
    per-state result. A union of a filtered and a re-aggregated branch would
    scan the fact table twice: Catalyst pushes the `state IS NOT NULL` filter
    into one branch, so the two branches no longer share their exchange.

    `by_location` exchanges by location alone, so that later aggregations per
    location need no exchange; only for keys of which a location holds few,
    such as the months of the calendar.
    """
    keys = list(keys)
    additive = list(additive)
    location = F.explode(F.array(F.col("state"), F.lit(NATIONWIDE))).alias("location")
    both = per_state.select(location, *keys, *additive).where(F.col("location").isNotNull())
    if by_location:
        both = both.repartition("location")
    return both.groupBy("location", *keys).agg(*[F.sum(c).alias(c) for c in additive])
