"""Headline figures and their display cards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import py_round_text
from ..plans.pre_aggregated import mean_duration


def kpis(df: DataFrame) -> DataFrame:
    """One row: `total_users`, `avg_duration`, `paid_duration`, from a single aggregate.

    Users are distinct `userId`s where a NULL id counts as one more user (as a
    distinct-rows count does). The mean ignores NULL durations; the paid total
    sums raw-paid listens and is NULL when there are none.
    """
    return df.agg(
        (
            F.count_distinct("userId")
            + F.coalesce(F.max(F.col("userId").isNull().cast("int")), F.lit(0))
        ).alias("total_users"),
        mean_duration(df).alias("avg_duration"),
        F.sum(F.when(F.col("subscription") == "paid", F.col("duration"))).alias("paid_duration"),
    )


def kpi_cards(k: DataFrame) -> DataFrame:
    """The three dashboard cards from `kpis`: users in thousands, mean minutes, paid hours in thousands.

    Rounding is Python's `round` (ties to even); a NULL figure gives a NULL card.
    """
    return k.select(
        "total_users",
        "avg_duration",
        "paid_duration",
        F.concat(py_round_text("total_users / 1000.0D"), F.lit("k+")).alias("users_card"),
        F.concat(py_round_text("avg_duration / 60.0D"), F.lit(" MIN")).alias("listening_card"),
        F.concat(py_round_text("paid_duration / 3600000.0D"), F.lit("k+ H")).alias("paid_card"),
    )
