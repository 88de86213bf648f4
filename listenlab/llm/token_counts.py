"""Token counts of a corpus from its exact histogram of encoded lengths.

Documents are summed by encoded length. Suffix sums over the lengths then answer, for every context limit: the documents and
tokens of at least that length, and the tokens that are left if longer documents are cut there. Quantiles are read off the same sums.

How it runs: each task encodes its texts (`bpe.token_lengths`) and sends one row per length. Suffix sums are taken in steps: inside
blocks of `BLOCK` lengths, over the blocks of each block of blocks, and so on `STEPS` times, so that a window holds at most `BLOCK` rows, but for the last,
which holds one for each `BLOCK` ^ `STEPS` tokens of a group's longest document.

Defined results: null and empty texts have length 0. Repeated rows count each time. Null groups are a group. An
empty table has no lengths. Quantile q of n documents is the length of document ceil(q n) in order of length, the first for q = 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import token_lengths
from .common import stash

BLOCK, STEPS = 64, 3


def length_histogram(docs: DataFrame, path: str, pattern: str, text_col: str = "text", group_cols: tuple[str, ...] = ()) -> DataFrame:
    """The group columns, n_tokens and documents: how many documents have that length."""
    lengths = token_lengths(docs, path, pattern, text_col, group_cols)
    return lengths.groupBy(*group_cols, "n_tokens").agg(F.count(F.lit(1)).alias("documents"))


def suffix_sums(histogram: DataFrame, group_cols: tuple[str, ...] = ()) -> DataFrame:
    """For each length as a context limit: documents_at_least, tokens_at_least, truncated_total, total, and rank_from to rank_to.

    truncated_total: tokens if documents are cut to n_tokens. Ranks number the documents by length, from 1.
    """
    rows = stash(histogram, "length-histogram")  # read by each step
    rows = rows.withColumn("tokens", F.col("documents") * F.col("n_tokens"))
    base = rows = rows.withColumns({f"block_{k}": F.expr(f"n_tokens div {BLOCK**k}") for k in range(1, STEPS + 1)})
    for k in range(1, STEPS + 1):
        # Of each block: the sums of the later ones in the next larger block, or in the group.
        parent = [f"block_{k + 1}"] if k < STEPS else []
        sums = base.groupBy(*group_cols, f"block_{k}", *parent).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        within = W.partitionBy(*group_cols, *parent)
        later = within.orderBy(F.desc(f"block_{k}")).rowsBetween(W.unboundedPreceding, -1)
        keys = [*group_cols, f"block_{k}"]
        more = [F.coalesce(F.sum(x).over(later), F.lit(0)).alias(f"later_{x}_{k}") for x in ("documents", "tokens")]
        if not parent:
            more += [F.sum(x).over(within).alias(f"all_{x}") for x in ("documents", "tokens")]
        sums = sums.select(*(F.col(c).alias(f"s_{c}") for c in keys), *more)
        on = F.lit(True)
        for c in keys:
            on = on & F.col(c).eqNullSafe(F.col(f"s_{c}"))
        rows = rows.join(sums, on).drop(*(f"s_{c}" for c in keys))
    for x in ("documents", "tokens"):
        rows = rows.withColumn(f"later_{x}", sum((F.col(f"later_{x}_{k}") for k in range(1, STEPS + 1)), F.lit(0)))
    here = W.partitionBy(*group_cols, "block_1").orderBy(F.desc("n_tokens"))
    docs_here, tokens_here = F.sum("documents").over(here), F.sum("tokens").over(here)
    rows = rows.withColumn("documents_at_least", F.col("later_documents") + docs_here).withColumn("tokens_at_least", F.col("later_tokens") + tokens_here)
    cut = F.col("all_tokens") - F.col("tokens_at_least") + F.col("documents_at_least") * F.col("n_tokens")
    first = F.col("all_documents") - F.col("documents_at_least") + 1
    return rows.select(
        *group_cols, "n_tokens", "documents", "documents_at_least", "tokens_at_least", cut.alias("truncated_total"),
        F.col("all_tokens").alias("total"), first.alias("rank_from"), (first + F.col("documents") - 1).alias("rank_to"),
    )


def quantiles(sums: DataFrame, qs: list[float], group_cols: tuple[str, ...] = ()) -> DataFrame:
    """The group columns, q and n_tokens."""
    n = F.max("rank_to").over(W.partitionBy(*group_cols)) if group_cols else F.col("documents_at_least") + F.col("rank_from") - 1
    rows = sums.withColumn("n", n).withColumn("q", F.explode(F.array(*map(F.lit, map(float, qs)))))
    rank = F.greatest(F.ceil(F.col("q") * F.col("n")), F.lit(1))
    return rows.filter(rank.between(F.col("rank_from"), F.col("rank_to"))).select(*group_cols, "q", "n_tokens")


def truncated_totals(histogram: DataFrame, limits: list[int], group_cols: tuple[str, ...] = ()) -> DataFrame:
    """The group columns, limit and tokens: what is left of each group if documents are cut to the limit."""
    each = [F.struct(F.lit(x).cast("long").alias("limit"), F.least(F.col("n_tokens"), F.lit(x)).alias("kept")) for x in limits]
    rows = histogram.select(*group_cols, "documents", F.inline(F.array(*each)))
    return rows.groupBy(*group_cols, "limit").agg(F.sum(F.col("documents") * F.col("kept")).alias("tokens"))
