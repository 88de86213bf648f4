"""Periodic runs of words: every maximal repetition of a text, and the text with each run's repeats left out.

A run is a stretch of consecutive words with smallest period q, of at least `min_words` and 2 q words, that no neighbouring word extends.

A run of period q holds two neighbouring points of the grid 0, q, 2q, ..., so the pairs of neighbours of all grids, a harmonic sum of
n log n, are all that need asking. Those whose words agree, with a neighbour's on one side, are the candidates. How far a candidate's
period reaches is answered exactly by the run-length grammar of `recompression`, forward and backward. A stretch found for several periods has the smallest.

How it runs: one `mapInArrow` over the documents, without a shuffle. A task joins texts up to `BATCH_CHARS` characters, with a mark
of its own between any two, and builds one grammar for them; a longer text has one by itself. Grid pairs are made for `GRID` words and extended for `CANDIDATES` pairs at a time.

Defined results: null and empty texts have no words and no runs; their collapsed text is empty. Rows stand for themselves, so repeated rows have equal
results, and null ids pass. An empty table gives an empty result. The columns n_words, runs and collapsed replace those of the same name; all others pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, portions, ship, small
from .recompression import Extensions, levels

MIN_WORDS = 12
BATCH_CHARS = 1_500_000
GRID = 1 << 14
CANDIDATES = 1 << 19

RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
_words = re.compile(WORD).findall
_grid: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []


def grid_pairs(low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of every grid point in low <= place < high that has a neighbour before it: the period divides the place."""
    period = np.arange(1, high)
    first = np.maximum(-(-low // period), 1) * period
    times = np.maximum((high - 1 - first) // period + 1, 0)
    period, first = np.repeat(period, times), np.repeat(first, times)
    step = np.arange(len(period)) - np.repeat(np.cumsum(times) - times, times)
    return first + step * period, period


def _pairs_below(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The grid pairs of n words, in pieces."""
    if not _grid:  # the first piece serves all short texts: sorted by place, with the number of pairs below each
        place, period = grid_pairs(1, GRID)
        order = np.argsort(place, kind="stable")
        _grid.append((place[order], period[order], np.searchsorted(place[order], np.arange(GRID + 1))))
    place, period, below = _grid[0]
    k = below[min(n, GRID)]
    yield place[:k], period[:k]
    for low in range(GRID, n, GRID):
        yield grid_pairs(low, min(low + GRID, n))


class _Candidates:
    """Collects candidates and turns them into runs, at most about `CANDIDATES` at a time."""

    def __init__(self, ids: np.ndarray, min_words: int):
        self.ids, self.min_words, self.found = ids, min_words, np.zeros((0, 3), np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n, self.sides = 0, None

    def add(self, x: np.ndarray, period: np.ndarray) -> None:
        for i in range(0, len(x), CANDIDATES):
            self.waiting.append((x[i : i + CANDIDATES], period[i : i + CANDIDATES]))
            self.n += len(self.waiting[-1][0])
            if self.n >= CANDIDATES:
                self._extend()

    def _extend(self) -> None:
        if self.sides is None:  # the grammar of all the words, built for the first candidates
            grammar = list(levels(self.ids))
            self.sides = Extensions(len(self.ids), grammar, backward=True), Extensions(len(self.ids), grammar)
        x, p = (np.concatenate(v) for v in zip(*self.waiting, strict=True))
        self.waiting, self.n = [], 0
        start, end = x - self.sides[0].of(x, x + p), x + p + self.sides[1].of(x, x + p)
        kept = end - start >= np.maximum(self.min_words, 2 * p)
        rows = np.concatenate([self.found, np.stack([start, end, p], axis=1)[kept]])
        rows = rows[np.lexsort(rows.T[::-1])]
        first = np.ones(len(rows), bool)  # the smallest period of a stretch
        first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        self.found = rows[first]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and smallest period of each run, by start."""
        if self.waiting:
            self._extend()
        return tuple(self.found.T)


def find_runs(texts: list[list[str]], min_words: int = MIN_WORDS) -> list[np.ndarray]:
    """For each list of words its runs, (start, length, period) in rows, by start and period."""
    mark = [object()]  # equal to no word, and numbered anew at each place
    flat = mark + [w for words in texts for w in (*words, mark[0])]
    ids = pd.factorize(np.array(flat, object))[0].astype(np.int64)
    sizes = np.array([len(words) for words in texts], np.int64)
    base = np.concatenate([[1], 1 + np.cumsum(sizes + 1)])[:-1]
    marks = np.concatenate([[0], base + sizes])
    ids[marks] = ids.max() + 1 + np.arange(len(marks))
    candidates = _Candidates(ids, min_words)
    for b, n in zip(base.tolist(), sizes.tolist(), strict=True):
        if n < min_words:
            continue
        for place, period in _pairs_below(n):
            y = place + b
            x = y - period
            hit = np.flatnonzero((ids[x] == ids[y]) & (period <= n // 2))
            x, y, period = x[hit], y[hit], period[hit]
            # A run of 3 words or more has at least 2 in a row that agree with those a period on.
            hit = (ids[x + 1] == ids[y + 1]) | (ids[x - 1] == ids[y - 1]) if min_words >= 3 else slice(None)
            candidates.add(x[hit], period[hit])
    start, end, p = candidates.runs()
    text = np.searchsorted(base, start, side="right") - 1
    rows = np.stack([start - base[text], end - start, p], axis=1)
    rows = rows[np.lexsort((p, start))]
    return np.split(rows, np.searchsorted(np.sort(text), np.arange(1, len(texts))))


def collapse(words: list[str], runs: np.ndarray) -> str:
    """The words but for those that a run holds after its first period, joined by spaces."""
    if not len(runs):
        return " ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return " ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with n_words, runs (an array of start, length, period by start and period) and collapsed."""
    ship(docs.sparkSession)
    new = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())]
    src = docs.select(*[c for c in docs.columns if c not in [f.name for f in new]])
    out = T.StructType([*src.schema.fields, *new])
    at = src.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            n, runs, collapsed = [], [], []
            for part in portions(b.column(at).to_pylist(), BATCH_CHARS):
                words = [_words(t or "") for t in part]
                found = find_runs(words, min_words)
                n += map(len, words)
                runs += found
                collapsed += map(collapse, words, found)
            ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
            rows = np.concatenate([np.zeros((0, 3), np.int64), *runs])
            fields = [pa.field(f.name, pa.int64(), False) for f in RUN]
            lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(c) for c in rows.T.copy()], fields=fields))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64()), lists, pa.array(collapsed, pa.string())], names=out.names)

    return src.mapInArrow(run, out)


def plant(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with repeats in about a tenth of the texts: with h = crc32(id as text), g = h div 10, n words and h mod 10 = 0, each word from
    a = g mod n on becomes word a + (i - a) mod p, with p = 1 + (n - a) div (3 + g mod 8). Other texts, and those of a null id, stay."""
    h = F.crc32(F.col(id_col).cast("string"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    own = "__plant_words"
    rows = docs.withColumn(own, F.when(chosen, F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})"), 1)))
    n, g = F.size(own), F.floor(h / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(own, a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.slice(F.concat(F.slice(own, F.lit(1), a), repeated), F.lit(1), n), " ")
    return rows.withColumn(text_col, F.when(chosen & (n > 0), planted).otherwise(F.col(text_col))).drop(own)


def longest(runs: Column) -> Column:
    """The run of greatest length; of equal ones that of the smallest start, then period; null if there is none."""
    return F.array_max(F.transform(runs, lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
