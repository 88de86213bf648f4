"""SimHash near-duplicates through a segment-popcount embedding.

A text is lower-cased (A-Z), split at ASCII white space and cut into shingles of
`shingle` words, repeats included. Bit i of its fingerprint is 1 if bit i is set in over half of the
shingles' XXH64 hashes (seed 42). A text with fewer words is one shingle; a text without words has
fingerprint zero. Fingerprints at `max_bits` or fewer differing bits are linked; documents in one
connected group are near-duplicates.

Finding the links: the 64 bits are 32 segments of two bits. A fingerprint's point is the number of
set bits in each segment, and the Manhattan distance of two points is at most their Hamming distance. Points are kept as a
thermometer code (0, 1, 2 as 00, 01, 11), so that the Manhattan distance is again a count of differing bits.
Of the 32 coordinates, the upper or the lower half contains at most 1 of a distance of up to 3. So each half is a grid of unit
cells and the range join has radius 1 in it: points whose half has an odd sum look into their own cell and all
neighbours, points of even sum only into their own. Whoever meets in a cell is compared by the Manhattan
distance of the whole point first and by the exact fingerprints then.

How it runs: equal fingerprints are one point (a group of exact copies is summed before the shuffle). A point looks into
about 26 cells. Cells with a single visitor, or that are no visitor's own, go in the JVM. Cells with over `HOT_CELL` visitors are cut again, and as long as it takes: of four
quarters of the bits, two fingerprints within 3 bits agree in one, so their visitors meet by its value, and no link is lost. A group where all but `FREE_BITS` bits agree
is small by itself, so no group is larger than 4096. In a cell, a search that takes linked
points out of the candidates writes a spanning forest, not all pairs. Groups are then found by `graph.components`.

Defined results: a null text is an empty text. Rows of equal id are rows of their own and have the same id in results. A null id belongs to a
group, but is its smallest id only where no other is. An empty table gives an empty result. The columns
fingerprint and component_id replace those of the same name; other columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, small, stash
from .graph import components

SHINGLE = 3
MAX_BITS = 3
HASH_SEED = 42
HOT_CELL = 4096
#: With so few bits free, a group can hold no more than 4096 fingerprints.
FREE_BITS = 12
GROUP = ("half", "cell", "mask", "value")
#: Hashes whose bits are counted at once, so that the longest text needs no more memory.
COUNT_BLOCK = 1 << 15
LOW_BITS = 0x5555555555555555


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)]
    else:
        joined, ends, at = b" ".join(words), [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0, *(e + 1 for e in ends[:-shingle])]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], HASH_SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=True)]
    set_in = np.zeros(64, np.int64)
    every = np.array(hashes, ">u8")
    for i in range(0, len(every), COUNT_BLOCK):
        part = every[i : i + COUNT_BLOCK].view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_in * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """`docs` with fp, the fingerprint as a signed long, for the text."""
    ship(docs.sparkSession)
    src = docs.drop("fp")
    at = src.columns.index(text_col)
    kept = [i for i in range(len(src.columns)) if i != at]
    out = T.StructType([*(src.schema[i] for i in kept), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(at)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), pa.array(fps)], names=out.names)

    return src.mapInArrow(run, out)


def fingerprint_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def thermometer(fp: Column) -> Column:
    """The popcounts of the 32 two-bit segments, each as a thermometer code in the segment's place."""
    low, up = F.lit(LOW_BITS), F.shiftrightunsigned(fp, 1)
    either, both = fp.bitwiseOR(up).bitwiseAND(low), fp.bitwiseAND(up).bitwiseAND(low)
    return either.bitwiseOR(F.shiftleft(both, 1))


def _thermometers(x: np.ndarray) -> np.ndarray:
    low, up = np.uint64(LOW_BITS), x >> np.uint64(1)
    return ((x | up) & low) | ((x & up & low) << np.uint64(1))


def cells(points: DataFrame) -> DataFrame:
    """(half, nth, cell, fp) for every cell that a point looks into, its own with nth 0; `points` has fp, each once."""
    code = thermometer(F.col("fp"))
    halves = F.array(
        F.struct(F.lit(1).alias("half"), F.shiftrightunsigned(code, 32).alias("own")),
        F.struct(F.lit(0).alias("half"), code.bitwiseAND(F.lit(0xFFFFFFFF)).alias("own")),
    )
    rows = points.select("fp", F.inline(halves))
    # One step of a coordinate turns over one bit of the code; a turn to 10 is no step.
    flips = F.array(*(F.lit(1 << i) for i in range(32)))
    steps = F.filter(F.transform(flips, lambda f: F.col("own").bitwiseXOR(f)), _is_code)
    seen = F.when(F.bit_count("own") % 2 == 1, F.concat(F.array("own"), steps)).otherwise(F.array("own"))
    return rows.select("half", F.posexplode(seen).alias("nth", "cell"), "fp")


def _is_code(c: Column) -> Column:
    low = F.lit(LOW_BITS & 0xFFFFFFFF)
    return F.shiftright(c, 1).bitwiseAND(low).bitwiseAND(F.bitwise_not(c)) == 0


def spanning_links(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links between the fingerprints of a cell that connect all that are linked there.

    Candidates leave once linked, so a cell of near copies costs about its size, and memory is that of the cell's fingerprints.
    """
    links, left = [], fps[1:]
    codes = _thermometers(left)
    waiting = [fps[0]]
    while len(left):
        if not waiting:
            waiting, left, codes = [left[0]], left[1:], codes[1:]
            continue
        p = waiting.pop()
        near = np.bitwise_count(codes ^ _thermometers(p[None])) <= max_bits  # the lower bound
        near[near] = np.bitwise_count(left[near] ^ p) <= max_bits
        if near.any():
            hit = left[near]
            links += [(p, h) for h in hit]
            waiting.extend(hit)
            left, codes = left[~near], codes[~near]
    return links


def _parts(mask: int) -> list[int]:
    """`mask` with each quarter of its free bits."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * k // 4 for k in range(5)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bounded(rows: DataFrame) -> DataFrame:
    """Groups (half, cell, mask, value) of `rows` (with their size n), those of more than `HOT_CELL` fingerprints cut until none is, or few bits are free.

    All in a group agree in the bits of its mask. Two that differ in 3 bits at most agree in one quarter of the others, where they meet again.
    """
    spark, done, masks = rows.sparkSession, [], [0]
    while True:
        done.append(rows.filter(F.col("n") <= HOT_CELL))
        hot = rows.filter(F.col("n") > HOT_CELL)
        if 64 - masks[0].bit_count() <= FREE_BITS or hot.isEmpty():
            done.append(hot)
            break
        cut = [(_signed(m), _signed(part)) for m in masks for part in _parts(m)]
        parts = F.broadcast(spark.createDataFrame(cut, "mask long, part long"))  # 4 times as many as before, at most 4 ^ 6
        hot = hot.join(parts, "mask").select("half", "cell", F.col("part").alias("mask"), F.col("fp").bitwiseAND(F.col("part")).alias("value"), "fp")
        hot = stash(hot, "fingerprint-cut")
        sizes = hot.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        rows = hot.join(sizes, list(GROUP))
        masks = [part for m in masks for part in _parts(m)]
    return reduce(DataFrame.unionByName, done)


def linked(points: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) pairs of fingerprints that connect all within `max_bits`, at most 3; `points` has fp, each once."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits: two halves with radius 1 cover 3 bits")
    ship(points.sparkSession)
    met = cells(points)
    # Points within distance 1 meet in the own cell of one of them. Sums by cell are partial in each task, then joined.
    used = met.groupBy("half", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("least")).filter("n > 1 and least = 0")
    met = stash(met.join(used.drop("least"), ["half", "cell"]).select("half", "cell", "fp", "n"), "fingerprint-cells")
    met = _bounded(met.withColumns({"mask": F.lit(0).cast("long"), "value": F.lit(0).cast("long")}))
    met = met.select(*GROUP, "fp").repartition(*GROUP).sortWithinPartitions(*GROUP, "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in _arrays(batches):
            rows = b if rest is None else np.concatenate([rest, b], axis=1)
            change = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0)) + 1
            if not len(change):
                rest = rows
                continue
            yield _links_of(rows[:, : change[-1]], change, max_bits)
            rest = rows[:, change[-1] :]
        if rest is not None and rest.shape[1]:
            yield _links_of(rest, np.array([], np.int64), max_bits)

    return met.mapInArrow(run, "a long, b long").distinct()


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        if b.num_rows:
            yield np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])


def _links_of(rows: np.ndarray, change: np.ndarray, max_bits: int) -> pa.RecordBatch:
    n = rows.shape[1]
    starts = np.concatenate([[0], change[change < n]])
    ends = np.concatenate([starts[1:], [n]])
    fps = rows[4].view(np.uint64) if rows[4].flags.c_contiguous else np.ascontiguousarray(rows[4]).view(np.uint64)
    links = []
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        if e - s > 1:
            links += spanning_links(fps[s:e], max_bits)
    pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """(id, row, fp, group, component_id) of every row: row is a hash of id and text, group a fingerprint of its group."""
    src = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    fps = stash(fingerprints(src, "text", shingle), "fingerprints")
    points = stash(fps.groupBy("fp").agg(F.min("id").alias("first")), "fingerprint-points")
    found = components(stash(linked(points.select("fp"), max_bits), "fingerprint-links"))
    # A fingerprint without links is its own group.
    named = points.join(found, points["fp"] == found["node"], "left").withColumn("group", F.coalesce("component", "fp"))
    firsts = named.groupBy("group").agg(F.min("first").alias("component_id"))
    named = named.select(F.col("fp").alias("point"), "group").join(firsts, "group")
    return fps.join(named, F.col("fp") == F.col("point")).drop("point")


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """A row per row of `docs`: the id, fingerprint (16 hex digits) and component_id, the smallest id reachable."""
    rows = _grouped(docs, id_col, text_col, shingle, max_bits)
    return rows.select(F.col("id").alias(id_col), fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """`docs` with one row of each group: of the smallest id (a null id is the largest), by a hash of the text if rows share that id.

    Rows are picked by narrow columns; texts are exchanged once, by the picked rows' hash.
    """
    rows = _grouped(docs, id_col, text_col, shingle, max_bits)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    picked = rows.groupBy("group").agg(first.alias("first")).select(F.col("first.row").alias("__first")).distinct()
    kept = docs.withColumn("__row", row_key(id_col, text_col))
    kept = kept.join(picked, kept["__row"] == picked["__first"], "left_semi")
    order = W.partitionBy("__row").orderBy(*(F.xxhash64(c) for c in docs.columns))
    return kept.withColumn("__nth", F.row_number().over(order)).filter(F.col("__nth") == 1).drop("__row", "__nth")
