"""Spelling variants: words one edit apart, and the frequent word that each rare one stands for.

Words are near if exactly one code point inserted, deleted or replaced makes one of the other. A word's form is its near word with most
occurrences, if that has `ratio` times as many as the word itself; its root is where following the forms ends.

Near words are found by a sorted-list scan. The words of a block, in order, share prefixes with their neighbours; a word meets those after it
row by row of the edit matrix, of which only three cells can be 1 or less. The rows of a prefix that the next word shares (the least common
prefix of the words between) are used again, and where all cells of a row exceed 1, all words with that prefix are left out.

Blocks make the scan parallel. A block (size, low, high) holds the words of `size` and `size` + 1 code points with the same first `low` and the same last `size` -
`high`; only what lies between them is compared. Every word is in the blocks of its first and its second half, once with its own size and once with one
less. A pair belongs to the block in which its first difference lies, so each is met once. A block of more than `BLOCK_WORDS` is cut at the middle of
low..high, again and again; where low and high are next to each other, at most a + a^2 words of an alphabet of a differ, so no group grows with the table.

How it runs: one pass counts words in each task, in dictionaries of at most `HELD_WORDS`, then one sum by word. Blocks are dealt by their key and
sorted inside partitions, and a task streams through them and holds one block. A word's near words are summed in the task (count and best),
so that pairs are never written. Roots follow by pointer jumping: forms grow by `ratio`, so a chain of at most 63 log 2 / log ratio forms needs the logarithm of
that many joins. Nothing is collected or broadcast.

Defined results: null and empty texts have no words. Repeated rows count each time. A null id spoils no word. Ties of a form go to the smallest word in
code-point order. Without words the result is empty. Other columns take no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from math import ceil, log, log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, small, stash

MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
HELD_WORDS = 200_000
BLOCK_WORDS = 4096

# The letters of a word.
LETTERS = r"[A-Za-zÀ-ÿ]+"
_runs = re.compile(LETTERS).findall
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

BLOCK = ("size", "low", "high", "head", "tail")


def spoiled(doc_id: str | None, word: str, every: int) -> str:
    """`word` without one code point, in one of `every` pairs of a document and a word."""
    if doc_id is not None and every:
        h = zlib.crc32(f"{doc_id}:{word}".encode())
        if h % every == 0:
            at = h % len(word)
            return word[:at] + word[at + 1 :]
    return word


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, spoil: int = 0
) -> DataFrame:
    """(word, n): the lower-cased words of enough code points and occurrences. `spoil`: one in so many is spoiled first."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([*total], pa.string()), pa.array([*total.values()], pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for b in small(batches, 128):
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for word, n in Counter(_runs(text or "")).items():
                    word = spoiled(i, word.lower() if word.isascii() else word.translate(_LOWER), spoil)
                    if len(word) >= min_chars:
                        total[word] += n
            if len(total) > HELD_WORDS:
                yield counted()
        yield counted()

    src = docs.select(F.col(id_col).cast("string"), text_col)
    words = src.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.filter(F.col("n") >= min_count)


def _shared(a: str, b: str) -> int:
    """The length of the common prefix."""
    for n, (x, y) in enumerate(zip(a, b, strict=False)):
        if x != y:
            return n
    return min(len(a), len(b))


def near_pairs(words: list[str]) -> Iterator[tuple[int, int, int]]:
    """(i, j, first difference) of every two of `words`, sorted and different, that are one edit apart, i before j.

    The lengths of `words` differ by one at most.
    """
    end = len(words)
    shared = [0, *(_shared(a, b) for a, b in zip(words, words[1:], strict=False))]
    # less[j]: the next place after j that shares less with the word before it than j does.
    less, waiting = [end] * end, []
    for j, s in enumerate(shared):
        while waiting and shared[waiting[-1]] > s:
            less[waiting.pop()] = j
        waiting.append(j)
    for i in range(end - 1):
        n = len(words[i])
        mine = words[i] + "\0\0"  # for the cells to the right of its end, which no result is read from
        # rows[d]: the edits from the first d code points of the other word to my first d - 1, d and d + 1.
        j = i + 1
        common = shared[j]
        rows = [(2, 0, 1), *[(1, 0, 1)] * common]
        while j < end:
            other = words[j]
            depth, size = shared[j], len(other)
            common = min(common, depth)
            del rows[depth + 1 :]
            a, b, c = rows[depth]
            while depth < size:
                x = other[depth]
                left = min(a + (mine[depth - 1] != x), b + 1) if depth else b + 1
                mid = min(b + (mine[depth] != x), c + 1, left + 1)
                a, b, c = left, mid, min(c + (mine[depth + 1] != x), mid + 1)
                depth += 1
                if a > 1 and b > 1 and c > 1:
                    break
                rows.append((a, b, c))
            else:
                if (a, b, c)[n - size + 1] == 1:
                    yield i, j, common
                j += 1
                continue
            # No word that shares these code points can be near.
            j += 1
            while j < end and shared[j] >= depth:
                j = less[j]


def _halves(words: DataFrame) -> DataFrame:
    """The blocks that each word is in: its halves, as the longer and as the shorter or equal of a pair."""
    size = F.explode(F.array(F.char_length("word"), F.char_length("word") - 1))
    rows = words.select("word", "n", size.alias("size"))
    return _blocks(rows.withColumns({"low": F.lit(0), "high": F.col("size")}))


def _blocks(rows: DataFrame) -> DataFrame:
    """`rows` (word, n, size, low, high) in the blocks of both halves of low..high, with what lies between the block's shared ends."""
    middle = F.expr("(low + high) div 2").cast("int")
    ends = F.explode(F.array(F.struct(F.col("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high"))))
    rows = rows.withColumn("ends", ends).select("word", "n", "size", "ends.low", "ends.high")
    tail = F.col("size") - F.col("high")
    return rows.withColumns({
        "head": F.substring("word", F.lit(1), F.col("low")),
        "tail": F.when(tail > 0, F.substring("word", F.char_length("word") - tail + 1, tail)).otherwise(""),
        "part": F.substring("word", F.col("low") + 1, F.char_length("word") - tail - F.col("low")),
    })


def _bounded(words: DataFrame, most: int) -> DataFrame:
    """The rows of all blocks, those of more than `most` words cut until they are below it or one code point wide."""
    done, rows = [], _halves(words)
    while True:
        large = rows.filter("high - low > 1").groupBy(*BLOCK).count().filter(F.col("count") > most).drop("count")
        large = stash(large, "spelling-large")
        if large.isEmpty():
            break
        done.append(rows.join(large, list(BLOCK), "left_anti"))
        rows = stash(_blocks(rows.join(large, list(BLOCK), "left_semi")), "spelling-cut")
    for more in done:
        rows = rows.unionByName(more)
    return rows


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n_near, best): of each word of (word, n) with near words, their number and the one of largest n as a struct (n, word)."""
    ship(words.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

        for (size, low, high, head, tail), block in groupby(rows(), lambda r: r[:5]):
            *_, parts, counts = zip(*block, strict=True)
            if len(parts) == 1 or min(map(len, parts)) > high - low:
                continue  # longer words meet in the blocks of their own size
            words = [head + x + tail for x in parts]
            near, best = [0] * len(parts), [(0, "")] * len(parts)
            for i, j, first in near_pairs(parts):
                # The pair's own block: two longer words meet in another size, a later first difference in another half.
                if min(len(parts[i]), len(parts[j])) > high - low or first >= high - low and high < size:
                    continue
                for x, y in ((i, j), (j, i)):
                    near[x] += 1
                    best[x] = min(best[x], (-counts[y], words[y]))
            found = [i for i, k in enumerate(near) if k]
            columns = [[words[i] for i in found], [near[i] for i in found], [-best[i][0] for i in found], [best[i][1] for i in found]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, types)), names=["word", "n_near", "near_n", "near_word"])

    types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    rows = _bounded(words, block_words).select(*BLOCK, "part", "n")
    found = rows.repartition(*BLOCK).sortWithinPartitions(*BLOCK, "part").mapInArrow(scan, "word string, n_near long, near_n long, near_word string")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near_word").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def roots(forms: DataFrame, ratio: float = RATIO) -> DataFrame:
    """(word, root): where following the forms of (word, form) ends, for each word with a form."""
    found = stash(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    # Occurrences grow by `ratio` at each step and fit a long, so chains are bounded; each round doubles the steps.
    for _ in range(ceil(log2(63 * log(2) / log(ratio) + 1)) + 1):
        further = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = found.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        jumped = stash(jumped, "spelling-roots")
        found = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            return found
    raise RuntimeError("roots: chains of forms are longer than their counts allow")


def variants(words: DataFrame, ratio: float = RATIO, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of a vocabulary (word, n) of different words; n is a long, `ratio` above 1."""
    words = stash(words.select("word", "n"), "spelling-words")
    near = near_words(words, block_words)
    is_form: Column = -F.col("best.n") >= ratio * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("best.n")).alias("form_n"),
    )
    rows = stash(rows, "spelling-forms")
    root = roots(rows.filter(F.col("form").isNotNull()), ratio)
    return rows.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
