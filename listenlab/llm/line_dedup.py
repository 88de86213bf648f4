"""Line de-duplication with levelled sorted runs of line hashes.

A line's key is the line stripped of ASCII white space at both ends, with A-Z
lower-cased. Keys of at least `min_chars` code points that occur in at least
`min_docs` documents lose all their lines, except in the document with the
largest id that holds the key. All other lines stay, joined by line feeds.

How it runs:

1. One pass over the texts emits each row's distinct long keys as 128-bit hashes, with a key of the row (a hash of id and text). No text is shuffled here.
2. The hashes are taken in batches of descending document id, so the first batch
   that holds a hash also holds its largest document. `SortedRuns` merge-anti-joins
   a batch against the runs: a new hash enters with its holder, a known hash
   only adds to its document count. The batch then becomes a run of its own,
   and `fan_in` runs of a level are compacted into one run of the next.
3. The last compaction leaves one row per hash. Hashes of enough documents are
   joined to the (row, hash) rows; each row key gets its list of hashes to drop, never more than one text's lines.
4. A filter of `FILTER_BITS` bits, of any table's row keys with a list, tells which rows may lose lines. The others pass without an exchange; these are joined to
   their lists and filtered, whole texts, in Arrow batches. What the filter lets through in vain costs an exchange only.

Runs are tables bucketed and sorted by hash, in the shared folder: a batch is exchanged once and then
merged with every run without another exchange. A hash of a third of all
documents is one row a batch, summed before the shuffle; its join in step 3 is
an ordinary join, which Spark splits by skew.

Defined results: a null or empty text is one empty line. Rows of equal id are
one document (their keys count once; repeated rows lose the same lines). A null
id is one document, smaller than any other. Ids may have any type with an order. An empty table gives an empty
result. Columns named `n_lines` or `n_dropped` are replaced; all others pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import new_output_path, remove
from .common import SPACE_BYTES, hash_sample, ship, small, stash

MIN_CHARS = 40
MIN_DOCS = 5
HASH, ROW = ("h1", "h2"), ("r1", "r2")
CUT_SAMPLE = 4096
#: Bits of the filter, and how many of them a row key sets.
FILTER_BITS, FILTER_SETS = 1 << 24, 4


def line_key(line: bytes) -> bytes:
    # bytes.lower() changes A-Z only
    return line.strip(SPACE_BYTES).lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    # Fewer bytes than min_chars means fewer code points; only longer keys are decoded to count.
    return len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars)


def _digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _keyed_lines(text: str | None, min_chars: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text, and for each the hash of its key (None if the key is too short)."""
    lines = (text or "").encode("utf-8").split(b"\n")
    keys = map(line_key, lines)
    return lines, [_digest(k) if _long_enough(k, min_chars) else None for k in keys]


def row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits of a row: equal for rows of equal id and text only."""
    return [F.xxhash64(F.lit(seed), id_col, text_col).alias(c) for seed, c in enumerate(ROW)]


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """The distinct long keys of each row: (doc_id, r1, r2, h1, h2)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            counts, found = [], []
            for text in b.column(3):
                own = {h for h in _keyed_lines(text.as_py(), min_chars)[1] if h}
                counts.append(len(own))
                found.extend(own)
            h = np.frombuffer(b"".join(found), dtype=">i8").astype("i8").reshape(-1, 2)
            at = pa.array(np.repeat(np.arange(b.num_rows), counts))
            yield pa.RecordBatch.from_arrays([*(c.take(at) for c in b.columns[:3]), pa.array(h[:, 0]), pa.array(h[:, 1])], names=["doc_id", *ROW, *HASH])

    src = docs.select(F.col(id_col).alias("doc_id"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    return src.mapInArrow(emit, T.StructType([src.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in (*ROW, *HASH))]))


class SortedRuns:
    """Levelled runs of (h1, h2, n_docs, holder), each a table bucketed and sorted by hash.

    `add` merges a batch in: hashes that no run knows keep their holder, known
    ones only add their count. `fan_in` runs of one level are compacted into one
    of the next, so n batches leave at most fan_in * log(n) runs to merge with.
    """

    def __init__(self, spark: SparkSession, buckets: int, fan_in: int = 2):
        self.spark, self.buckets, self.fan_in = spark, buckets, fan_in
        self.name = "line_runs"
        self.levels: list[list[str]] = [[]]
        self.paths: dict[str, str] = {}

    def _write(self, rows: DataFrame) -> str:
        """`rows`: partitioned into the runs' buckets."""
        name = f"{self.name}_{uuid.uuid4().hex}"
        path = self.paths[name] = new_output_path(self.spark, f"llm-{name}")
        rows.write.option("path", path).bucketBy(self.buckets, *HASH).sortBy(*HASH).format("parquet").saveAsTable(name)
        return name

    def _remove(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, self.paths.pop(name))

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, *HASH)

    def _runs(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def first_seen(self, batch: DataFrame) -> DataFrame:
        """The rows of `batch` whose hash is in no run: a merge anti-join with each run."""
        for r in self._runs():
            batch = batch.join(self.spark.table(r).select(*HASH), list(HASH), "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        """`batch`: one row per hash with n_docs and holder; its documents are in no earlier batch."""
        batch = self._dealt(batch)
        for i, r in enumerate(self._runs()):
            seen = self.spark.table(r).select(*HASH, F.lit(True).alias(f"seen_{i}"))
            batch = batch.join(seen, list(HASH), "left")
        known = F.coalesce(*[F.col(f"seen_{i}") for i in range(len(self._runs()))], F.lit(False))
        holder = F.when(~known, F.col("holder"))
        self.levels[0].append(self._write(batch.select(*HASH, "n_docs", holder.alias("holder"))))
        self._compact()

    def _merged(self, names: list[str]) -> DataFrame:
        """Merge joins of bucketed runs: no exchange. (A union of bucketed scans is planned as if it kept their buckets, but may be read without them.)"""
        rows = self.spark.table(names[0])
        for n in names[1:]:
            more = self.spark.table(n).select(*HASH, F.col("n_docs").alias("more_docs"), F.col("holder").alias("more_holder"))
            n_docs = F.coalesce("n_docs", F.lit(0)) + F.coalesce("more_docs", F.lit(0))
            holder = F.coalesce("holder", "more_holder")  # only the first batch of a hash has its holder
            rows = rows.join(more, list(HASH), "full").select(*HASH, n_docs.alias("n_docs"), holder.alias("holder"))
        return rows

    def _compact(self) -> None:
        for k, level in enumerate(self.levels):
            if len(level) >= self.fan_in:
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(self._write(self._merged(level)))
                for r in level:
                    self._remove(r)
                level.clear()

    def merged(self) -> DataFrame:
        """One row per hash over all runs."""
        return self._merged(self._runs())

    def drop(self) -> None:
        for name in [*self.paths]:
            self._remove(name)
        self.levels = [[]]


def repeated_lines(hashes: DataFrame, min_docs: int = MIN_DOCS, batches: int = 4) -> DataFrame:
    """(h1, h2, holder) of every hash found in at least `min_docs` documents.

    `batches` cuts the ids into ranges of about equal rows, largest ids first.
    """
    spark = hashes.sparkSession
    edges = _cuts(hashes, batches)
    doc = F.col("doc_id")
    runs = SortedRuns(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        for i in range(len(edges) + 1):
            own = F.lit(True) if i == 0 else doc <= edges[i - 1]
            own = own & (doc > edges[i]) if i < len(edges) else own | doc.isNull()
            per_doc = hashes.filter(own).select(*HASH, "doc_id").distinct()
            runs.add(per_doc.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("holder")))
        return stash(runs.merged().filter(F.col("n_docs") >= min_docs).select(*HASH, "holder"), "repeated-lines")
    finally:
        runs.drop()


def _cuts(hashes: DataFrame, batches: int) -> list:
    """The ids between batches of about equal rows, the largest first, by a bounded sample; ids of any type."""
    if batches < 2:
        return []
    ids = sorted(r[0] for r in hash_sample(hashes.select("doc_id", *HASH).dropna(subset=["doc_id"]), CUT_SAMPLE, "doc_id", *HASH).select("doc_id").collect())
    return sorted({ids[len(ids) * i // batches] for i in range(1, batches)} if ids else set(), reverse=True)


def _filter(keys: DataFrame) -> np.ndarray:
    """Bits set for the row keys of `keys`, by one sum of at most `FILTER_BITS` / 64 rows."""
    at = F.explode(F.array(*(F.pmod(F.xxhash64(*ROW, F.lit(i)), F.lit(FILTER_BITS)) for i in range(FILTER_SETS))))
    bit = F.expr("shiftleft(1L, int(at % 64))")
    words = keys.select(at.alias("at")).groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.astype("<i8").view(np.uint8)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = 4,
) -> DataFrame:
    """`docs` with repeated lines removed from the text, plus n_lines (before) and n_dropped."""
    spark = docs.sparkSession
    ship(spark)
    hashes = stash(line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    repeated = repeated_lines(hashes, min_docs, batches)
    drops = (
        hashes.join(repeated, list(HASH))
        .filter(~F.col("doc_id").eqNullSafe(F.col("holder")))
        .groupBy(*(F.col(c).alias(f"__line_{c}") for c in ROW))
        .agg(F.collect_set(F.concat(_be(F.col("h1")), _be(F.col("h2")))).alias("__line_drop"))
    )
    drops = stash(drops, "line-drops")
    bits = spark.sparkContext.broadcast(_filter(drops.select(*(F.col(f"__line_{c}").alias(c) for c in ROW))))  # FILTER_BITS / 8 bytes
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    keys = [f"__line_{c}" for c in ROW]
    src = docs.select(*kept, *(c.alias(k) for c, k in zip(row_key(id_col, text_col), keys, strict=True)))
    at = F.array(*(F.pmod(F.xxhash64(*keys, F.lit(i)), F.lit(FILTER_BITS)).cast("int") for i in range(FILTER_SETS)))
    src = src.withColumn("__line_at", at)
    out = T.StructType([*docs.select(*kept).schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    at_text = kept.index(text_col)

    def passed(b: pa.RecordBatch, wanted: bool) -> pa.RecordBatch:
        """The rows whose bits are all set, or the others."""
        places = b.column(b.num_columns - 1).flatten().to_numpy().reshape(-1, FILTER_SETS)
        inside = (bits.value[places >> 3] >> (places & 7) & 1).all(axis=1)
        return b.filter(pa.array(inside == wanted))

    def whole(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(rows):
            b = passed(b, False)
            texts = [t or "" for t in b.column(at_text).to_pylist()]
            yield result(b, texts, [t.count("\n") + 1 for t in texts], [0] * b.num_rows)

    def candidates(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(rows):
            b = passed(b, True)
            yield pa.RecordBatch.from_arrays(b.columns[:-1], names=[*kept, *keys])

    def strip(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(rows):
            texts, n_lines, n_dropped = [], [], []
            for text, drop in zip(b.column(at_text), b.column(len(kept)), strict=True):
                drop = set(drop.as_py() or ())
                lines, hashed = _keyed_lines(text.as_py(), min_chars)
                keep = [x for x, h in zip(lines, hashed, strict=True) if h not in drop] if drop else lines
                texts.append(b"\n".join(keep).decode("utf-8"))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(keep))
            yield result(b, texts, n_lines, n_dropped)

    def result(b: pa.RecordBatch, texts: list[str], n_lines: list[int], n_dropped: list[int]) -> pa.RecordBatch:
        cols = [pa.array(texts, b.schema.field(at_text).type) if i == at_text else b.column(i) for i in range(len(kept))]
        return pa.RecordBatch.from_arrays([*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=out.names)

    moved = src.mapInArrow(candidates, src.drop("__line_at").schema).join(drops, keys, "left").select(*kept, "__line_drop")
    return src.mapInArrow(whole, out).unionByName(moved.mapInArrow(strip, out))


def _be(h: Column) -> Column:
    """A long as its eight big-endian bytes."""
    return F.unhex(F.lpad(F.hex(h), 16, "0"))
