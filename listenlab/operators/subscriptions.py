"""Effective subscription: a user with any paid listen counts as paid for all listens.

Raw `subscription` is what each listen logged. The effective one overrides it
with "paid" for every listen of a user who has at least one paid listen,
anywhere and at any time (the flag is always computed over all locations).
A NULL user is never flagged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def paid_users(df: DataFrame) -> DataFrame:
    """Distinct non-NULL users with at least one raw-paid listen (`userId`)."""
    return (
        df.where((F.col("subscription") == "paid") & F.col("userId").isNotNull())
        .select("userId")
        .distinct()
    )


#: Rows without a user match no paid user; for the join they are dealt over so many keys.
NULL_USER_PARTS = 997


def with_paid_flag(rows: DataFrame, listens: DataFrame, *spread_by: str) -> DataFrame:
    """`rows` (with `userId`, `subscription`) with `subscription` "paid" for users who are paid anywhere in `listens`.

    One lazy left join to the distinct paid users; Spark picks broadcast or
    sort-merge by their size. Rows are the preserved side, whose skewed
    partitions AQE can split, and rows without a user, which may be many, are
    dealt by `spread_by` instead of meeting in one partition.
    """
    paid = paid_users(listens).select(F.col("userId").alias("_paid_user"), F.lit(0).alias("_paid_part"))
    part = F.when(F.col("userId").isNull(), F.pmod(F.xxhash64(*spread_by), F.lit(NULL_USER_PARTS))).otherwise(F.lit(0))
    rows = rows.withColumn("_part", part.cast("int"))
    joined = rows.join(paid, (F.col("userId") == F.col("_paid_user")) & (F.col("_part") == F.col("_paid_part")), "left")
    effective = F.when(F.col("_paid_user").isNotNull(), F.lit("paid")).otherwise(F.col("subscription"))
    return joined.withColumn("subscription", effective).drop("_part", "_paid_user", "_paid_part")


def effective_subscription(df: DataFrame) -> DataFrame:
    """Every listen with `subscription` replaced by the effective subscription
    and the logged value kept as `raw_subscription`."""
    rows = df.withColumn("raw_subscription", F.col("subscription"))
    return with_paid_flag(rows, df, *df.columns).select(*df.columns, "raw_subscription")
