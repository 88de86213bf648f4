"""Subscription mix: listens per raw subscription, with percentages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import py_text
from ..plans.locations import at_location, rollup_locations
from ..plans.pre_aggregated import listens_of
from ..sources.schema import NATIONWIDE


def _with_percentage(counts: DataFrame, partition_by: list[str]) -> DataFrame:
    # The window runs over the aggregated counts: a handful of rows per location.
    total = F.sum("count").over(Window.partitionBy(*partition_by))
    pct = F.col("count").cast("double") / total * F.lit(100.0)
    return counts.withColumn("percentage", pct).withColumn(
        "percentage_text", F.concat(py_text("percentage", 1), F.lit("%"))
    )


def subscription_mix(df: DataFrame, location: str = NATIONWIDE) -> DataFrame:
    """`subscription, count, percentage, percentage_text` for one location, most first.

    `percentage` is count / total * 100 as a double; `percentage_text` is its
    one-decimal display form, rounded like Python (ties to even on the binary value).
    """
    counts = at_location(df, location).groupBy("subscription").agg(listens_of(df).alias("count"))
    return _with_percentage(counts, []).orderBy(F.desc("count"), F.asc_nulls_last("subscription"))


def subscription_mix_all(df: DataFrame) -> DataFrame:
    """`subscription_mix` for Nationwide and every state in one job."""
    per_state = df.groupBy("state", "subscription").agg(listens_of(df).alias("count"))
    by_loc = rollup_locations(per_state, ["subscription"], ["count"])
    return _with_percentage(by_loc, ["location"])
