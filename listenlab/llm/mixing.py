"""Mixing sources to target weights, with DataFrame operations only.

A document's size is its number of words. The sources, in code point order with
null last, get the weights in turn and share `share` times all words. A
source's target stops at `most` times its size; what is left over is shared
again by weight among the others until no target is above its bound.

How it runs:

1. Each row gets a random key, the hash of its id and text; rows are summed by
   (source, key), so repeated rows collapse before the shuffle.
2. Keys are range-partitioned within each source by their top bits. Words are
   summed per (source, range); a window over those sums gives each range's start, and a
   window inside a range the running sum. No window holds a whole source.
3. A source is taken floor(target / size) whole times; the rest is its budget.
   The key whose words cross the budget is the source's cut.
4. Rows are joined to the cuts, one row a source, and decide for themselves: below the
   cut one epoch more, at the cut the words still missing.

Defined results: a null text has no words. An empty table gives an empty result.
A source without words has target 0. Rows equal in id and text share a key; at
the cut they get equal parts (rounded down), so a source's words fall short by at most the
number of such copies. Nulls in `doc_id` or `source` are values like any other. The
columns size, source_size, target and taken replace those of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, stash, word_count

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
#: Top bits of the key that number the ranges of a source: 4096 ranges.
RANGE_BITS = 12


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """`sizes` (source, source_size: a row each) with the target of each source.

    A source is at its bound if bound / weight is below the level to which the
    others rise. Sorted by that ratio, the bounded sources come first, so running
    sums over the table of sources give the level after any number of them.
    """
    turn = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(turn) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.select("source", "source_size", weight.alias("w")).withColumn("bound", F.col("source_size") * F.lit(float(most)))
    by_ratio = W.orderBy(F.col("bound") / F.col("w"), F.col("source").asc_nulls_last())
    before, here_on = by_ratio.rowsBetween(W.unboundedPreceding, -1), by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    words = F.sum("source_size").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)) * F.lit(float(share))
    level = (words - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("w").over(here_on)
    rows = rows.withColumn("level", level)
    # The level at the first source that stays below its bound holds for it and all after it.
    free = F.when(F.col("bound") > F.col("level") * F.col("w"), F.col("level"))
    rows = rows.withColumn("level", F.first(free, ignorenulls=True).over(by_ratio.rowsBetween(W.unboundedPreceding, W.currentRow)))
    target = F.coalesce(F.least(F.col("level") * F.col("w"), F.col("bound")), F.col("bound"))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def random_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def source_cuts(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source: source_size, target, epochs (whole ones), cut (a key) and cut_words (for each row at the cut).

    `rows` has source, size and key. Rows below the cut are taken once more;
    where a source's budget ends with its last epoch, cut is null.
    """
    keyed = rows.groupBy("source", "key").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("copies"))
    keyed = stash(keyed.withColumn("range", F.shiftright("key", 64 - RANGE_BITS)), "mix-keys")
    ranges = keyed.groupBy("source", "range").agg(F.sum("words").alias("range_words"))
    sizes = ranges.groupBy("source").agg(F.sum("range_words").alias("source_size"))
    budget = targets(sizes, weights, share, most).withColumn("whole", F.round("target").cast("long"))
    # Cast down: 0 / 0 is null under `nullif`, and a source without words has no epoch.
    epochs = F.coalesce(F.expr("whole div nullif(source_size, 0)"), F.lit(0))
    budget = budget.withColumn("epochs", epochs).withColumn("left", F.col("whole") - F.col("epochs") * F.col("source_size"))

    start = F.sum("range_words").over(W.partitionBy("source").orderBy("range")) - F.col("range_words")
    ranges = ranges.withColumn("start", start)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    b = budget.select(F.col("source").alias("b_source"), "left")
    ranges = ranges.join(b, F.col("source").eqNullSafe(F.col("b_source"))).drop("b_source")
    r = ranges.select(F.col("source").alias("r_source"), F.col("range").alias("r_range"), "start", "left")
    within = W.partitionBy("source", "range").orderBy("key")
    placed = (
        keyed.join(r, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("range") == F.col("r_range")))
        .withColumn("end", F.col("start") + F.sum("words").over(within))
        .withColumn("begin", F.col("end") - F.col("words"))
    )
    cuts = placed.filter((F.col("begin") <= F.col("left")) & (F.col("left") < F.col("end"))).select(
        "source", F.col("key").alias("cut"), F.expr("(`left` - begin) div copies").alias("cut_words")
    )
    cuts = budget.join(cuts, same(budget, cuts), "left").select(
        budget["source"], "source_size", "target", "epochs", "cut", "cut_words"
    )
    # Written, so that its size is known when the rows are joined to it: small tables then go to the rows.
    return stash(cuts.coalesce(1), "mix-cuts")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """`docs` with size, source_size, target and taken: the words that the mix takes of each row."""
    size, key = word_count(F.col(text_col)), random_key(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(source_col).alias("source"), size.alias("size"), key.alias("key"))
    cuts = source_cuts(rows, weights, share, most).select(
        F.col("source").alias("__mix_source"), *(F.col(c).alias(f"__mix_{c}") for c in ("source_size", "target", "epochs", "cut", "cut_words"))
    )
    src = docs.withColumns({"size": size, "__mix_key": key})
    more = (
        F.when(F.col("__mix_key") < F.col("__mix_cut"), F.col("size"))
        .when(F.col("__mix_key") == F.col("__mix_cut"), F.least(F.col("__mix_cut_words"), F.col("size")))
        .otherwise(F.lit(0))
    )
    out = src.join(cuts, F.col(source_col).eqNullSafe(F.col("__mix_source")), "left").withColumns(
        {
            "source_size": F.col("__mix_source_size"),
            "target": F.col("__mix_target"),
            "taken": (F.col("size") * F.col("__mix_epochs") + more).cast("long"),
        }
    )
    return out.drop(*(c for c in out.columns if c.startswith("__mix_")))


def mixed_documents(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """The mix itself: a row for each time a document is taken, with `text` as far as it is taken.

    A document taken for 2.4 times its size comes three times, the last time with its
    first words only; one that isn't taken, or has no words, does not come.
    """
    full = (F.col("taken") / F.col("size")).cast("long")
    part = F.col("taken") - full * F.col("size")
    words = F.expr(f"regexp_extract_all({text_col}, r'{WORD}[\\x20\\x09-\\x0D]*', 0)")
    cut = F.when(part > 0, F.array_join(F.slice(words, F.lit(1), part.cast("int")), ""))
    texts = F.concat(F.array_repeat(F.col(text_col), full.cast("int")), F.array_compact(F.array(cut)))
    kept = mixed.filter((F.col("size") > 0) & (F.col("taken") > 0))
    return kept.withColumn("__mix_text", F.explode(texts)).withColumn(text_col, F.col("__mix_text")).drop("__mix_text")
