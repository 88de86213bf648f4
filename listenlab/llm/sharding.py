"""Sharding by histogram sort, with DataFrame operations only.

Rows are sorted by a 64-bit key and cut into shards of nearly equal bytes. The
key's top 40 bits hash the text and its low 24 bits the id, so equal texts are
neighbours, and even a text of a third of all rows can be cut. Rows equal in id and text
have equal keys; where they are more than a piece's rows, they are written once with copy
numbers, which take part in the low bits, so that they can be cut as well.

Splitters are found without sorting: bytes and rows are counted exactly below
candidate boundaries (the edges of key prefixes) over all partitions, and only the
prefixes that hold a target are probed again, one level finer, until every splitter is
within `tolerance`. Rows are then exchanged once. The probes that come back
to the driver are bounded by parameters, not by the rows.

Equal texts stay together where they can. Groups of more than `group_slack` of a shard, at most
shards / `group_slack`, are found by their bytes and put into shards whole, the largest first, each into the fullest shard that
has room for it. The splitters then deal the rest, so that the shards have equal bytes; boundaries between texts
are taken if they are within `group_slack` of a shard. Only a group that no shard has room for, such as one above a shard, is cut.

Inside a shard, rows are numbered from 0 without gaps: the exchange goes to many pieces of
about equal rows, whose first numbers are the exact counts below their boundaries.

Defined results: a null text has size 1, as an empty text has, and is in its group. A null id
is a value like any other. An empty table gives an empty result. Equal rows may swap
slots. The columns size, shard and slot replace those of the same name.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stash, utf8_size

SHARDS = 8
PIECES = 1024
TOLERANCE = 0.0005
GROUP_SLACK = 0.02
#: Key prefixes probed in turn, in bits; the first five end between texts.
LEVELS = (12, 20, 28, 34, 40, 48, 56, 64)
TEXT_BITS = 40
COPY = "__shard_copy"


@dataclass
class Splitter:
    """Rows with key >= at lie beyond; below: (bytes, rows) counted under it."""

    at: int
    below: tuple[int, int]


def sort_key(doc_id: Column, text: Column, copy: Column | None = None) -> Column:
    words = F.xxhash64(F.lit(0), F.coalesce(text, F.lit("")))
    low = (1 << (64 - TEXT_BITS)) - 1
    # A null copy number leaves the hash as it is.
    own = F.xxhash64(F.lit(0), doc_id, F.lit(None).cast("long") if copy is None else copy)
    return words.bitwiseAND(F.lit(~low)).bitwiseOR(own.bitwiseAND(F.lit(low)))


def find_splitters(keyed: DataFrame, goals: list[tuple[int, float, float, float]]) -> list[Splitter]:
    """A splitter for each goal (0: bytes or 1: rows, count wanted below, tolerance, tolerance between texts).

    `keyed` has key and size. Each round counts exactly, in one aggregation, the prefixes that hold a goal still open.
    """
    total = (0, 0)
    open_bins: dict[int, list[int]] = {0: list(range(len(goals)))}
    starts: dict[int, tuple[int, int]] = {0: (0, 0)}
    best: list[Splitter | None] = [None] * len(goals)
    last = 0
    for bits in LEVELS:
        child = F.shiftright("key", 64 - bits)
        rows = keyed if last == 0 else keyed.filter(F.shiftright("key", 64 - last).isin([*open_bins]))
        got = rows.groupBy(child.alias("bin")).agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
        by_parent: dict[int, list[tuple[int, int, int]]] = {}
        for bin_, b, n in got:
            by_parent.setdefault(0 if last == 0 else bin_ >> (bits - last), []).append((bin_, b, n))
        next_open: dict[int, list[int]] = {}
        next_starts: dict[int, tuple[int, int]] = {}
        for parent, wanted in open_bins.items():
            bins = sorted(by_parent.get(parent, []))
            edges = [starts[parent]]
            for _, b, n in bins:
                edges.append((edges[-1][0] + b, edges[-1][1] + n))
            if last == 0:
                total = edges[-1]
            for g in wanted:
                what, want, tolerance, slack = goals[g]
                k = min(max(bisect.bisect_right([e[what] for e in edges], want) - 1, 0), max(len(bins) - 1, 0))
                for i in (k, k + 1):
                    if i < len(edges) and bins:
                        # An edge stands before its bin, or after the last one.
                        at = bins[i][0] << (64 - bits) if i < len(bins) else (bins[-1][0] + 1) << (64 - bits)
                        old = best[g]
                        if old is None or abs(edges[i][what] - want) < abs(old.below[what] - want):
                            best[g] = Splitter(at, edges[i])
                error = abs(best[g].below[what] - want) if best[g] else 0
                if not bins or error <= (slack if bits >= TEXT_BITS else tolerance) or bins[k][2] <= 1 or bits == 64:
                    continue
                next_open.setdefault(bins[k][0], []).append(g)
                next_starts[bins[k][0]] = edges[k]
        open_bins, starts, last = next_open, next_starts, bits
        if not open_bins:
            break
    return [s or Splitter(-(1 << 63), total) for s in best]


def heavy_bins(keyed: DataFrame, measure: str, above: float, up_to: int) -> dict[int, int]:
    """The key prefixes of `up_to` bits that hold more than `above` of `measure` (bytes or rows), refined from the shorter ones that do."""
    total = F.sum("size") if measure == "bytes" else F.count(F.lit(1))
    found: dict[int, int] = {}
    for last, bits in zip((0, *LEVELS), LEVELS, strict=False):
        if bits > up_to:
            break
        rows = keyed if last == 0 else keyed.filter(F.shiftright("key", 64 - last).isin([*found]))
        sums = rows.groupBy(F.shiftright("key", 64 - bits).alias("bin")).agg(total.alias("b")).filter(F.col("b") > above)
        found = dict(sums.collect())
        if not found:
            break
    return found


def large_groups(keyed: DataFrame, above: float) -> dict[int, int]:
    """The bytes of each group of equal texts of more than `above`, by the text's bits of the key."""
    return heavy_bins(keyed, "bytes", above, TEXT_BITS)


def _numbered(docs: DataFrame, key: Column, hot: list[int]) -> DataFrame:
    """`docs` with the copy numbers of the rows with a key in `hot`, which are written once, so that they stay the same."""
    chosen = key.isin(hot)
    copies = stash(docs.filter(chosen).withColumn(COPY, F.monotonically_increasing_id()), "shard-copies")
    return docs.filter(~chosen).withColumn(COPY, F.lit(None).cast("long")).unionByName(copies)


def place(groups: dict[int, int], shards: int, room: float) -> dict[int, int]:
    """A shard for each group that fits whole: the largest first, into the fullest shard with room."""
    held, placed = [0] * shards, {}
    for group, size in sorted(groups.items(), key=lambda x: (-x[1], x[0])):
        fits = [i for i in range(shards) if held[i] + size <= room]
        if fits:
            placed[group] = max(fits, key=lambda i: (held[i], -i))
            held[placed[group]] += size
    return placed


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    pieces: int = PIECES,
    tolerance: float = TOLERANCE,
    group_slack: float = GROUP_SLACK,
) -> DataFrame:
    """`docs` with size (UTF-8 bytes of the text plus 1), shard and slot."""
    size = utf8_size(F.col(text_col)) + 1
    key = sort_key(F.col(id_col), F.col(text_col))
    keyed = stash(docs.select(key.alias("key"), size.alias("size")), "shard-keys")
    all_bytes, all_rows = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    hot = heavy_bins(keyed, "rows", max(all_rows / pieces, 1), 64)  # fewer than `pieces` keys
    if hot:
        docs = _numbered(docs, key, sorted(hot))
        key = sort_key(F.col(id_col), F.col(text_col), F.col(COPY))
        keyed = stash(docs.select(key.alias("key"), size.alias("size")), "shard-keys")
    part = all_bytes / shards
    groups = large_groups(keyed, part * group_slack)
    placed = place(groups, shards, part * (1 + group_slack))
    free = [part] * shards
    for group, i in placed.items():
        free[i] -= groups[group]
    # A shard filled above its part takes nothing more; the others share what is left.
    free = [max(x, 0.0) for x in free]
    share = (all_bytes - sum(groups[g] for g in placed)) / (sum(free) or 1)
    goals = [(0, sum(free[:i]) * share, part * tolerance, part * group_slack) for i in range(1, shards)]
    own = _placed(placed, F.col("key"))
    # Where the last shards take nothing more, a splitter may lie beyond the last key.
    ends = sorted(min(s.at, (1 << 63) - 1) for s in find_splitters(keyed.filter(own.isNull()), goals))
    # Rows are in order of shard and key: the shard takes the top bits, below two that stay 0, so that no mark is above a long.
    bits = (shards - 1).bit_length() + 2
    in_order = lambda key: F.shiftleft(_shard(placed, ends, key).cast("long"), 64 - bits).bitwiseOR(F.shiftrightunsigned(key, bits))
    keyed = keyed.select(in_order(F.col("key")).alias("key"), "size")
    step = all_rows / pieces
    inner = find_splitters(keyed, [(1, step * i, step / 4, step / 4) for i in range(1, pieces)])
    counts = dict(keyed.groupBy(F.shiftright("key", 64 - bits).cast("int")).count().collect())  # a row for each shard
    bases = [sum(counts.get(j, 0) for j in range(i)) for i in range(shards)]
    rows_below = dict((s.at, s.below[1]) for s in inner) | {i << (64 - bits): bases[i] for i in range(1, shards)}
    marks = sorted(rows_below)

    src = docs.withColumns({"size": size, "__shard_key": key}).withColumn("shard", _shard(placed, ends, F.col("__shard_key")))
    src = src.withColumn("__shard_key", in_order(F.col("__shard_key")))
    src = src.withColumn("__shard_piece", _count_not_above(marks, F.col("__shard_key")))
    # The rows below a piece, less the rows below its shard.
    first = F.element_at(_longs([0, *(rows_below[m] for m in marks)]), F.col("__shard_piece") + 1)
    base = F.element_at(_longs(bases), F.col("shard") + 1)
    order = W.partitionBy("__shard_piece").orderBy("__shard_key", id_col, "size")
    src = src.withColumn("slot", (first - base + F.row_number().over(order) - 1).cast("long"))
    return src.drop("__shard_key", "__shard_piece", COPY)


def _placed(placed: dict[int, int], key: Column) -> Column:
    """The shard of a key whose group is put into one whole, else null."""
    if not placed:
        return F.lit(None).cast("int")
    known, group = sorted(placed), F.shiftright(key, 64 - TEXT_BITS)
    at = F.greatest(_count_not_above(known, group), F.lit(1))
    return F.when(F.element_at(_longs(known), at) == group, F.element_at(_longs([placed[g] for g in known]), at).cast("int"))


def _shard(placed: dict[int, int], ends: list[int], key: Column) -> Column:
    return F.coalesce(_placed(placed, key), _count_not_above(ends, key))


def _count_not_above(marks: list[int], key: Column) -> Column:
    """How many of the sorted `marks` are at most `key`, by halving a constant array."""
    if not marks:
        return F.lit(0)
    known, steps = _longs(marks), [1 << i for i in reversed(range(len(marks).bit_length()))]
    further = lambda at, step: F.when(
        (at + step <= len(marks)) & (F.element_at(known, F.least(at + step, F.lit(len(marks)))) <= key), at + step
    ).otherwise(at)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)


def _longs(values: list[int]) -> Column:
    """A constant array, folded once by the optimizer."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
