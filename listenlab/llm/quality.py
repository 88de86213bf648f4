"""Quality rules: counts with fixed limits, and a classifier of hashed word and character n-grams.

A text's features are its lower-cased words (by their first `WORD_CHARS` code points) and word pairs, and its runs of 1 to `CHARS` code points, hashed into 2^`BITS`
places. A place's value is its share of the text's features, so a text's length doesn't count. Logistic regression over them is
fitted on labelled rows; a second one of its margin alone, on labelled rows apart (`CALIBRATE`), makes the margin a probability of label 1.

A text fails the base rules with fewer than `MIN_WORDS` words, or with more than `MAX_REPEAT` percent of its words in windows of three
words that it holds twice or more. Of the others, those with a probability of at least `KEEP` are kept.

How it runs: the labelled rows' features are written to the shared folder, and Spark's own logistic regression is fitted over them, by
sums of gradients over the tasks. It learns from the `FIT_ROWS` labels with the smallest hashes of their ids, each of weight one however many rows hold its
id. Weights go to the tasks with their code (2^`BITS` numbers); counts and scores are one `mapInArrow` over the documents without a shuffle,
whole texts, `PIECE` code points at a time.

Defined results: null and empty texts have no words, and so fail. Null and other labels than 0 and 1 are not learnt from, nor are those of ids without a
text and of held-out ids (crc32(id as text) mod 3 is 1), from which accuracy is measured. Without labels of both kinds every probability is 1, so the base rules alone decide. Repeated rows have
equal results. An empty table gives an empty result. The columns in `COLUMNS` replace those of the same name; all others pass.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import new_output_path
from .common import WORD, hash_sample, ship, small

MIN_WORDS = 50
MAX_REPEAT = 50
KEEP = 0.5

FIT_ROWS = 10_000
#: One in so many of the labels calibrates.
CALIBRATE = 5
BITS, CHARS, WORD_CHARS = 17, 3, 32
PIECE = 1 << 18
SCALE, RIDGE, ROUNDS = 100.0, 1e-4, 40

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COLUMNS = (*COUNTS, "base_failed", "quality", "kept")

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_words = re.compile(WORD).findall

_MIX, _STEP = np.uint32(0x9E3779B1), np.uint32(0x01000193)
_POWERS = np.concatenate([np.cumprod(np.full(WORD_CHARS, 0x85EBCA6B, np.uint32), dtype=np.uint32), np.zeros(1, np.uint32)])


def repeated_words(words: list[str]) -> int:
    """How many words stand in a window of three words that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    held = np.zeros(len(words), bool)
    for i, w in enumerate(windows):
        if times[w] > 1:
            held[i : i + 3] = True
    return int(held.sum())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """`COUNTS` of a text."""
    text = text or ""
    words, lines = _words(text), text.split("\n")
    repeated = 0
    if len(set(lines)) < len(lines):
        times = Counter(lines)
        repeated = sum(n - 1 for line, n in times.items() if n > 1 and _words(line))
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), repeated, repeated_words(words)


def places(text: str | None) -> Iterator[np.ndarray]:
    """The hashed place of each feature of a text, in pieces."""
    code = np.frombuffer((text or "").encode("utf-32-le"), "<u4")
    for start in range(0, len(code), PIECE):
        # Features that begin in the piece; they may reach beyond it.
        own = min(PIECE, len(code) - start)
        yield from _places(code[max(start - 1, 0) : start + PIECE + 3 * WORD_CHARS], start > 0, own)


def _places(code: np.ndarray, after: bool, own: int) -> Iterator[np.ndarray]:
    """`after`: the first code point only tells whether a word begins at the second; `own`: how many may begin features."""
    space = (code == 32) | ((code >= 9) & (code <= 13))
    code, before = (code[1:], space[:-1]) if after else (code, np.concatenate([[True], space[:-1]]))
    space = space[1:] if after else space
    shift = np.uint32(32 - BITS)
    gram = np.zeros(len(code), np.uint32)
    for k in range(CHARS):
        gram = gram[: len(code) - k] * _STEP + code[k:] + np.uint32(k + 1)
        yield (gram[:own] * _MIX) >> shift
    # Words: from each beginning up to the next white space, the first WORD_CHARS code points of it.
    first = np.flatnonzero(~space & before)
    if not len(first):
        return
    lower = np.where((code >= 65) & (code <= 90), code + np.uint32(32), code)
    lower[space] = 0
    at = np.arange(len(code)) - np.repeat(np.concatenate([[0], first]), np.diff([0, *first.tolist(), len(code)]))
    word = np.add.reduceat(lower * _POWERS[np.minimum(at, WORD_CHARS)], first, dtype=np.uint32)
    mine = first < own
    yield ((word[mine] + np.uint32(7)) * _MIX) >> shift
    pairs = word[:-1] * _STEP + word[1:]
    yield ((pairs[mine[:-1]] + np.uint32(11)) * _MIX) >> shift


@dataclass
class Classifier:
    """Weights of the places, an intercept, and the calibration of the margin: chance = 1 / (1 + exp(-(a + b margin)))."""

    weights: np.ndarray
    intercept: float
    a: float
    b: float

    def margin(self, text: str | None) -> float:
        total, n = 0.0, 0
        for x in places(text):
            total += float(self.weights[x].sum())
            n += len(x)
        return self.intercept + (SCALE * total / n if n else 0.0)

    def chance(self, text: str | None) -> float:
        z = self.a + self.b * self.margin(text)
        return 1 / (1 + exp(-min(max(z, -500.0), 500.0)))


#: Where nothing can be learnt, every text has chance 1.
NOTHING_LEARNT = Classifier(np.zeros(1 << BITS), 0.0, 500.0, 0.0)


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32(id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _features(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(label, weight, calibrates, features) of the labelled rows, written and read again as vectors."""
    spark = docs.sparkSession
    sparse = VectorUDT.sqlType()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 64):
            rows = []
            for text in b.column(b.num_columns - 1).to_pylist():
                at, times = np.unique(np.concatenate([*places(text)]), return_counts=True)
                rows.append((0, 1 << BITS, at.astype(np.int32), SCALE * times / times.sum()))
            kinds = [pa.int8(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64())]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds]
            vectors = pa.StructArray.from_arrays(cols, names=sparse.names)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], vectors], names=["label", "weight", "calibrates", "features"])

    known = F.broadcast(known)  # at most FIT_ROWS rows
    texts = docs.select(id_col, text_col).filter(F.length(text_col) > 0)
    often = texts.join(known, F.col(id_col) == F.col("l_id")).groupBy("l_id", "label", "calibrates").agg((1 / F.count(F.lit(1))).alias("weight"))
    rows = texts.join(F.broadcast(often), F.col(id_col) == F.col("l_id")).select("label", "weight", "calibrates", text_col)
    made = rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("features", sparse)]))
    path = new_output_path(spark, "llm-quality-features")
    made.write.parquet(path)
    vectors = T.StructType([*made.schema.fields[:-1], T.StructField("features", VectorUDT())])
    return spark.read.schema(vectors).parquet(path)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Classifier:
    """Fit on some of the labelled rows and calibrate on the others; `NOTHING_LEARNT` unless both have both labels."""
    ship(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("double").alias("label")).distinct()
    known = known.filter(F.col("label").isin(0.0, 1.0) & F.col("l_id").isNotNull() & ~held_out(F.col("l_id")))
    known = hash_sample(known, FIT_ROWS, "l_id", "label")
    known = known.withColumn("calibrates", F.pmod(F.xxhash64(F.lit(1), "l_id"), F.lit(CALIBRATE)) == 0)
    rows = _features(docs, known, id_col, text_col)
    if rows.select("label", "calibrates").distinct().count() < 4:
        return NOTHING_LEARNT
    fit = LogisticRegression(weightCol="weight", regParam=RIDGE, maxIter=ROUNDS, standardization=False)
    model = fit.fit(rows.filter(~F.col("calibrates")))
    weights, intercept = model.coefficients.toArray(), model.intercept
    margin = F.element_at(vector_to_array(model.getRawPredictionCol()), 2)
    apart = model.transform(rows.filter("calibrates")).select("label", "weight", margin.alias("margin"))
    line = VectorAssembler(inputCols=["margin"], outputCol="features").transform(apart)
    line = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=ROUNDS, standardization=False).fit(line)
    return Classifier(weights, intercept, line.intercept, float(line.coefficients[0]))


def judge(docs: DataFrame, classifier: Classifier, text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """`docs` with `COLUMNS`; quality is the probability of label 1, of failed texts too."""
    spark = docs.sparkSession
    ship(spark)
    told = spark.sparkContext.broadcast(classifier)
    types = [*[T.LongType()] * len(COUNTS), T.BooleanType(), T.DoubleType(), T.BooleanType()]
    src = docs.select(*[c for c in docs.columns if c not in COLUMNS])
    out = T.StructType([*src.schema.fields, *map(T.StructField, COLUMNS, types)])
    at = src.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = told.value
        for b in small(batches):
            rows = []
            for text in b.column(at):
                text = text.as_py()
                own = counts(text)
                failed = own[0] < MIN_WORDS or 100 * own[-1] > MAX_REPEAT * own[0]
                chance = known.chance(text)
                rows.append((*own, failed, chance, not failed and chance >= keep))
            kinds = [*[pa.int64()] * len(COUNTS), pa.bool_(), pa.float64(), pa.bool_()]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * len(kinds), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=out.names)

    return src.mapInArrow(run, out)


def learn_and_judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """`docs` with `COLUMNS`, by a classifier of their labels."""
    return judge(docs, learn(docs, labels, id_col, text_col), text_col, keep)
