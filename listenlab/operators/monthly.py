"""Monthly listening minutes by effective subscription."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.locations import at_location, rollup_locations
from ..sources.schema import NATIONWIDE
from .subscriptions import with_paid_flag

_MONTH_KEYS = ["year", "month", "month_name"]


def _seconds_per_user_month(df: DataFrame) -> DataFrame:
    """Listening seconds per `(userId, year, month, month_name, state, raw subscription)`.

    The first aggregate runs on the fact table with a map-side partial step;
    everything after it works on this much smaller table.
    """
    return df.groupBy("userId", *_MONTH_KEYS, "state", "subscription").agg(
        F.sum("duration").alias("seconds")
    )


def _effective_seconds(df: DataFrame, location: str = NATIONWIDE) -> DataFrame:
    """The location's rows only, aggregated before they meet the paid users of all locations."""
    per_user = _seconds_per_user_month(at_location(df, location))
    return with_paid_flag(per_user, df, *_MONTH_KEYS, "state", "subscription")


def monthly_seconds(df: DataFrame, location: str = NATIONWIDE) -> DataFrame:
    """Seconds by `(year, month, month_name, effective subscription)` for one location.

    The location filter is on the listens and reaches the scan; the paid users
    are those of all locations.
    """
    eff = _effective_seconds(df, location)
    return eff.groupBy(*_MONTH_KEYS, "subscription").agg(F.sum("seconds").alias("seconds"))


def monthly_seconds_all(df: DataFrame) -> DataFrame:
    """`monthly_seconds` for Nationwide and every state in one job (`location` column)."""
    per_state = _effective_seconds(df).groupBy("state", *_MONTH_KEYS, "subscription").agg(
        F.sum("seconds").alias("seconds")
    )
    return rollup_locations(per_state, [*_MONTH_KEYS, "subscription"], ["seconds"], by_location=True)


def monthly_listening(df: DataFrame, location: str = NATIONWIDE) -> DataFrame:
    """Minutes by `(year, month, month_name, effective subscription)` for one location,
    ordered by year, month, subscription. `total_duration` is in minutes."""
    return (
        monthly_seconds(df, location)
        .select(*_MONTH_KEYS, "subscription", (F.col("seconds") / F.lit(60)).alias("total_duration"))
        .orderBy("year", "month", "subscription")
    )


def monthly_listening_all(df: DataFrame) -> DataFrame:
    """`monthly_listening` for Nationwide and every state in one job (`location` column)."""
    return monthly_seconds_all(df).select(
        "location", *_MONTH_KEYS, "subscription", (F.col("seconds") / F.lit(60)).alias("total_duration")
    )
