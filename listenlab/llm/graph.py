"""Connected components of a table of links, by large-star and small-star rounds.

Each round points every node at the smallest node it sees: first its larger neighbours, then its smaller ones. The links end as
stars around the smallest node of each component, after a number of rounds that grows with the logarithm of the nodes, also for long chains. Each round is
written to the shared folder, so that a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash

MAX_ROUNDS = 100


def _large_star(links: DataFrame) -> DataFrame:
    """Each node sends its larger neighbours to the smallest node among itself and its neighbours."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node sends its smaller neighbours, and itself, to the smallest of them. `links` has a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of `links` (a, b) can reach. Links of a node to itself name it."""
    state = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).dropna().distinct()
    alone = state.filter("a = b").select(F.col("a").alias("node"), F.col("b").alias("component"))
    state, before = state.filter("a <> b"), None
    for _ in range(MAX_ROUNDS):
        state = stash(_small_star(_large_star(state)), "components")
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components: not settled after {MAX_ROUNDS} rounds")
    stars = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = state.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(centres).unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))
