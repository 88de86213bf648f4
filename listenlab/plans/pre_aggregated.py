"""Listens counted ahead: many tables from two passes over the listens.

`plays` and `usage` are narrow sums of the listens. Operators that count or sum take them
in place of listens: a row then stands for `listens` listens, `duration` is
their sum and `timed` the number of those with a duration.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLAY_KEYS = ["artist", "song", "state", "subscription"]
USAGE_KEYS = ["userId", "year", "month", "month_name", "state", "subscription"]


def plays(df: DataFrame) -> DataFrame:
    """What was played: the base of artist, song and map tables."""
    return df.groupBy(*PLAY_KEYS).agg(F.count(F.lit(1)).alias("listens"))


def usage(df: DataFrame) -> DataFrame:
    """Who listened when: the base of headline, subscription and monthly tables."""
    return df.groupBy(*USAGE_KEYS).agg(
        F.count(F.lit(1)).alias("listens"), F.sum("duration").alias("duration"), F.count("duration").alias("timed")
    )


def listens_of(df: DataFrame) -> Column:
    """How many listens the rows of a group stand for."""
    return F.sum("listens") if "listens" in df.columns else F.count(F.lit(1))


def mean_duration(df: DataFrame) -> Column:
    """Mean duration of the listens that have one."""
    return F.try_divide(F.sum("duration"), F.sum("timed")) if "timed" in df.columns else F.avg("duration")
