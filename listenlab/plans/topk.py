"""Top-k by group, with deterministic ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a group that are ranked on their own first.
SALTS = 32


def by_count(count_col: str, keys: Sequence[str], ascending: bool = False) -> list[Column]:
    """Order by a count (descending unless `ascending`), ties by the keys ascending, NULLs last."""
    first = F.asc(count_col) if ascending else F.desc(count_col)
    return [first, *[F.asc_nulls_last(k) for k in keys]]


def top_k(
    df: DataFrame,
    k: int,
    order: Sequence[Column],
    partition_by: Sequence[str] = (),
    rank_col: str = "rank",
) -> DataFrame:
    """Keep the first `k` rows of each group under a total order, numbered 1..k.

    Without groups: a sort with a limit, which Spark runs as a top-k per task
    merged once, and then the numbers of those k rows. With groups: first the
    k rows of each of `SALTS` parts of a group, then of the group, so that a
    group holding most of the data (the "Nationwide" location) is never one
    task's, for any k.
    """
    if not partition_by:
        first = df.orderBy(*order).limit(k)
        return first.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
    part = Window.partitionBy(*partition_by, "_topk_part").orderBy(*order)
    parts = df.withColumn("_topk_part", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
    parts = parts.withColumn(rank_col, F.row_number().over(part)).where(F.col(rank_col) <= k).drop("_topk_part")
    whole = Window.partitionBy(*partition_by).orderBy(*order)
    return parts.withColumn(rank_col, F.row_number().over(whole)).where(F.col(rank_col) <= k)
