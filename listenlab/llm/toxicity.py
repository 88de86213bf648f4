"""Toxicity scores of deobfuscated texts.

A noisy channel writes words with leetspeak (`1d10t`), letters apart (`i d i o t`, `i.d.i.o.t`) and
repeated letters (`idiooot`). For each suspicious stretch, the letters that each character may stand for make a
lattice, and Viterbi's algorithm finds its cheapest reading: the channel's costs plus the cost of the letters
under a character language model. The restored words are then scored.

The language model counts 4-grams over `SYMBOLS` (a word's edge, a-z, and one symbol for every other
letter) in all documents. There are at most 28^4 counts, so the model's size is bounded for any corpus.

The classifier learns word and stem features. Of each toxic text, the word before a feature's first place counts, and a
feature's evidence is the number of different such words: a passage copied into a thousand texts, or a word repeated in one, counts once. Against it
stands the number of clean texts that hold it. It is fitted on the `FIT_ROWS` labels with the smallest hashes of their ids (a parameter), and
keeps every feature with `LEAST_EVIDENCE`. A text's evidence is the sum of the log odds of its telling words.
A logistic curve over the evidence and the number of words, fitted on the same rows with each row left out of the counts that judge it, makes the score, so that
one odd word in a long text counts less than in a short one.

How it runs: the counts are one pass with a partial sum in each task; the fit passes over the labelled rows
only; scoring is one `mapInArrow` over the documents without a shuffle.

Defined results: null and empty texts have the base score. Null labels are not learnt from. Repeated labels of one id count once, for one of the texts with that id; ids without a text
don't count. Without labels, or without toxic ones, every score is the base score. Repeated rows have equal scores. An empty table gives
an empty result. The columns score and predicted replace those of the same name.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from math import exp, log
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BoundedCache, hash_sample, held, ship, small, stash

THRESHOLD = 0.7
FIT_ROWS = 20_000
#: What a feature's evidence is weighed against; 5 different contexts and no clean text make 0.71.
DOUBT = 2.0
LEAST_EVIDENCE = 4
BASE_SCORE = 0.02
#: Features below this chance say nothing.
TELLING = 0.6

SYMBOLS, ORDER = 28, 4
EDGE, OTHER = 0, 27
CONTEXTS = SYMBOLS ** (ORDER - 1)
#: The letters that a character is written for in leetspeak.
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c",
}
#: Channel costs in nats.
LEET_COST, REPEAT_COST, GAP_COST, BREAK_COST = 0.7, 2.0, 0.3, 3.0
#: One letter for two, which words have of their own; longer runs have REPEAT_COST.
DOUBLE_COST = 3.0
#: A sign between two stretches of letters that is no word's end, and a word's end between letters set apart.
JOIN_COST, APART_COST = 4.0, 3.0
#: Any letter for one sign of MASKS between letters.
MASK_COST = 3.0
MASKS = "*#"
#: Nothing to see between two letters.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
CACHE_WORDS = 100_000
#: After so many runs of a stretch, what all readings share is settled, so that the texts carried along stay short.
LATTICE_RUNS = 400

_LEET_CLASS = re.escape("".join(LEET))
_LETTER = r"[^\W\d_]"
#: A chunk with a letter is worth a lattice if it has a leet character, a repeated letter, or anything between two letters.
_SUSPICIOUS = re.compile(rf"[{_LEET_CLASS}]|({_LETTER})\1|{_LETTER}[\W\d_]+{_LETTER}")
#: Between letters set apart: white space and any sign that is no letter's own.
_SEPARATOR = rf"(?:[^\w{_LEET_CLASS}]|_)"
#: Single characters set apart, between any characters but letters and digits.
_APART = re.compile(rf"(?<![^\W_])(?:[a-z{_LEET_CLASS}]{_SEPARATOR}+){{2,}}[a-z{_LEET_CLASS}](?![^\W_])")
#: Where that may begin; told from a blank before the text. It starts with a class of few characters, so it passes over words fast.
_MAY_APART = re.compile(rf"[\W_][a-z{_LEET_CLASS}]{_SEPARATOR}+[a-z{_LEET_CLASS}]{_SEPARATOR}+[a-z{_LEET_CLASS}]")
_GAP = re.compile(r"\s")
_RUN = re.compile(r"(.)\1*", re.DOTALL)
_WORDS = re.compile(rf"{_LETTER}+")
_UNDIVIDED = re.compile(rf"(?:{_LETTER}|[{_LEET_CLASS}])*").fullmatch
#: Letters that stand for themselves; and a stretch from a letter to a letter with nothing between but letters and leet characters.
_PLAIN = re.compile(r"(?:([a-z])(?!\1))*").fullmatch
_WHOLE = re.compile(rf"{_LETTER}(?:(?:{_LETTER}|[{_LEET_CLASS}])*{_LETTER})?").fullmatch
#: Signs that end a word and change no reading beside a letter.
_OUTER = ",.;:?'\"-)[]{}<>=~%&_"
_WIDE_FORMS = re.compile("[\uff01-\uff5e]")
_NARROW = {0xFF01 + i: chr(0x21 + i) for i in range(94)}


def _symbol_table() -> np.ndarray:
    """For each UTF-8 byte its symbol; 255: no symbol of its own (a continuation byte)."""
    table = np.full(256, EDGE, np.uint8)
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    table[ord("A") : ord("Z") + 1] = np.arange(1, 27)
    table[0x80:0xC0] = 255
    table[0xC0:] = OTHER
    return table


_TABLE = _symbol_table()


def ngram_counts(texts: list[str | None]) -> np.ndarray:
    """Counts of the 4-grams of symbols in `texts`, edges between words counted once."""
    data = np.frombuffer("\n".join(["", "", "", *(t or "" for t in texts), "", ""]).encode("utf-8"), np.uint8)
    s = _TABLE[data]
    s = s[s != 255]
    # Two edges in a row stand between words, so that the first letters are counted after an edge only.
    edge = s == EDGE
    keep = np.ones(len(s), bool)
    keep[1:] = ~(edge[1:] & edge[:-1])
    s = s[keep].astype(np.int64)
    s = np.repeat(s, np.where(s == EDGE, ORDER - 1, 1))
    if len(s) < ORDER:
        return np.zeros(SYMBOLS**ORDER, np.int64)
    code = s[3:] + SYMBOLS * (s[2:-1] + SYMBOLS * (s[1:-2] + SYMBOLS * s[:-3]))
    return np.bincount(code, minlength=SYMBOLS**ORDER)


def language_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Costs (negative log chances) of a symbol after three others, from counts over all documents."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**ORDER, np.int64)
        for b in small(batches, 256):
            total += ngram_counts(b.column(0).to_pylist())
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["gram", "n"])

    counted = docs.select(text_col).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    got = counted.toPandas()  # at most 28^4 rows
    counts = np.zeros(SYMBOLS**ORDER)
    counts[got["gram"].to_numpy(np.int64)] = got["n"].to_numpy(float)
    return costs(counts)


def costs(counts: np.ndarray) -> np.ndarray:
    """Each order's chances are mixed with those of the order below (Witten-Bell weights)."""
    chance = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, ORDER + 1):
        n = counts.reshape(-1, *([SYMBOLS] * order)).sum(axis=0).reshape(-1, SYMBOLS)
        seen, kinds = n.sum(axis=1, keepdims=True), (n > 0).sum(axis=1, keepdims=True)
        lower = np.tile(chance.reshape(-1, SYMBOLS), (SYMBOLS if order > 1 else 1, 1))
        weight = np.where(seen > 0, kinds, 1.0)
        chance = (n + weight * lower) / (seen + weight)
    return -np.log(chance).ravel()


def _symbol(x: str) -> int:
    return ord(x) - 96 if "a" <= x <= "z" else EDGE if x == " " else OTHER


@lru_cache(maxsize=4096)
def _options(c: str, n: int, inside: bool, gap: float = GAP_COST, end: float = 0.0) -> list[tuple[str, float, tuple[int, ...]]]:
    """What a run of n (3: or more) times c may stand for: the letters, their channel cost and their symbols.

    `gap`, `end`: the costs of a separator as nothing and as a word's end.
    """
    if c.isalpha():
        out = [[(c, 0.0)], [(c + c, 0.0), (c, DOUBLE_COST)], [(c, REPEAT_COST), (c + c, REPEAT_COST)]][n - 1]
    elif c in LEET:
        out = [(x * k, LEET_COST) for k in range(1, min(n, 2) + 1) for x in LEET[c]]
        out.append((" ", BREAK_COST if inside else 0.0))
    elif c in INVISIBLE:
        out = [("", 0.0)]
    else:
        out = [("", gap), (" ", end)]
        if c in MASKS and n == 1 and inside:
            out += [(chr(x), MASK_COST) for x in range(ord("a"), ord("z") + 1)]
    return [(letters, channel, tuple(map(_symbol, letters))) for letters, channel in out]


def _slots(stretch: str) -> list[list[tuple[str, float, tuple[int, ...]]]]:
    runs = [m.span() for m in _RUN.finditer(stretch)]
    if _UNDIVIDED(stretch, 1, len(stretch) - 1):
        return [_options(stretch[i], min(j - i, 3), 0 < i and j < len(stretch)) for i, j in runs]
    last = len(runs) - 1
    divides = [not (stretch[i].isalpha() or stretch[i] in LEET or stretch[i] in INVISIBLE) for i, _ in runs]
    # How many characters stand between separators, at each run; separators of one kind are as wide as the narrowest.
    sizes, at = [0] * len(runs), 0
    while at <= last:
        end = at
        while end <= last and not divides[end]:
            end += 1
        width = runs[end - 1][1] - runs[at][0] if end > at else 0
        sizes[at:end] = [width] * (end - at)
        at = max(end, at + 1)
    narrow = min((j - i for (i, j), d in zip(runs, divides, strict=True) if d), default=0)
    out = []
    for k, (i, j) in enumerate(runs):
        gap, end = GAP_COST, 0.0
        if divides[k] and 0 < k < last:
            left, right = sizes[k - 1], sizes[k + 1]
            gap = JOIN_COST if left > 1 and right > 1 else GAP_COST
            end = APART_COST if left == right == 1 and j - i <= narrow else 0.0
        out.append(_options(stretch[i], min(j - i, 3), 0 < i and j < len(stretch), gap, end))
    return out


_END = [(" ", 0.0, (EDGE,))]


class Restorer:
    """Reads obfuscated stretches by Viterbi's algorithm."""

    def __init__(self, model: np.ndarray):
        self.cost = array("d", model)
        self.read_chunks = BoundedCache(self._read_chunk, CACHE_WORDS)
        self.read_whole = BoundedCache(self.read, CACHE_WORDS)

    @staticmethod
    def lattice(stretch: str) -> list[list[tuple[str, float]]]:
        """For each run of a character the strings it may stand for, with their channel costs; a space ends a word."""
        return [[(letters, channel) for letters, channel, _ in options] for options in _slots(stretch)]

    def read(self, stretch: str) -> str:
        """The cheapest reading of a lower-case stretch."""
        cost = self.cost
        states = {0: (0.0, "")}  # by the last three symbols
        settled = []
        for i, options in enumerate([*_slots(stretch), _END], 1):
            after: dict[int, tuple[float, str]] = {}
            if len(options) == 1 and options is not _END and len(options[0][2]) == 1:
                # Nothing to choose: one letter, without channel costs.
                letters, _, (symbol,) = options[0]
                for context, (spent, text) in states.items():
                    at = context * SYMBOLS + symbol
                    total = spent + cost[at]
                    at %= CONTEXTS
                    if at not in after or total < after[at][0]:
                        after[at] = (total, text + letters)
                options = ()
            for context, (spent, text) in states.items() if options else ():
                for letters, channel, symbols in options:
                    at, total = context, spent + channel
                    for symbol in symbols:
                        if symbol:
                            total += cost[at * SYMBOLS + symbol]
                            at = (at * SYMBOLS + symbol) % CONTEXTS
                        elif at:
                            total += cost[at * SYMBOLS]
                            at = 0
                    if at not in after or total < after[at][0]:
                        after[at] = (total, text + letters)
            states = after
            if i % LATTICE_RUNS == 0:
                shared = commonprefix([text for _, text in states.values()])
                settled.append(shared)
                states = {at: (spent, text[len(shared) :]) for at, (spent, text) in states.items()}
        return "".join(settled) + min(states.values())[1]

    def restore(self, text: str | None) -> list[str]:
        """The words of a text, lower-cased and restored, in order."""
        text = text or ""
        if not text.isascii() and _WIDE_FORMS.search(text):
            text = text.translate(_NARROW)
        text = text.lower()
        # Letters set apart by white space are one chunk: their gaps become dots.
        if _MAY_APART.search(f" {text}"):
            text = _APART.sub(lambda m: _GAP.sub(".", m.group()), text)
        return " ".join(map(self.read_chunks.__getitem__, text.split())).split()

    def _read_chunk(self, chunk: str) -> str:
        inner = chunk.strip(_OUTER)
        if _PLAIN(inner):
            return inner
        if _WHOLE(inner):
            return self.read_whole[inner] if _SUSPICIOUS.search(inner) else inner
        words = _WORDS.findall(chunk)
        if not words or not _SUSPICIOUS.search(chunk):
            return " ".join(words)
        return self.read(chunk)


def features(word: str) -> list[str]:
    """A word and its stems."""
    return [f"{word}$", *(word[:k] for k in (4, 5, 6) if len(word) > k)]


def without_marks(word: str) -> str:
    """`word` without the marks on its letters."""
    return word if word.isascii() else "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


def _restorer(model: bytes) -> Restorer:
    """The restorer that this process keeps."""
    return held(("restorer", zlib.crc32(model)), lambda: Restorer(np.frombuffer(model)))


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32(id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@dataclass
class Classifier:
    """For each telling feature (toxic contexts, clean texts); the logistic weights of 1, evidence, log(1 + words)."""

    evidence: dict[str, tuple[int, int]]
    weights: tuple[float, float, float]

    def tells(self, word: str, own: int | None = None) -> float:
        """The log odds of a word, by itself, without marks or the best of its stems; 0.0 if they don't tell.

        `own`: the label of a text learnt from, which is left out of the counts.
        """
        best = 0.0
        own_features = features(word) if word.isascii() else {*features(word), f"{without_marks(word)}$"}
        for f in own_features:
            if f in self.evidence:
                toxic, clean = self.evidence[f]
                best = max(best, chance(toxic - (own == 1), clean - (own == 0)))
        return log(best / (1 - best)) if best >= TELLING else 0.0

    @cached_property
    def heads(self) -> frozenset[str]:
        """The first four letters of every telling feature; no other word tells, but for marks on its letters."""
        return frozenset(f.removesuffix("$")[:4] for f in self.evidence)

    def weigh(self, words: list[str], tells: Callable[[str], float]) -> float:
        """The evidence of the different words of a text, summed in order of size, so that it is alike in every run."""
        heads = self.heads
        return sum(sorted(tells(w) for w in set(words) if w[:4] in heads or not w.isascii()))

    def score(self, words: list[str], tells: Callable[[str], float]) -> float:
        a, b, c = self.weights
        z = a + b * self.weigh(words, tells) + c * log(1 + len(words))
        return 1 / (1 + exp(-min(max(z, -500.0), 500.0)))


def chance(toxic: float, clean: float) -> float:
    return toxic / (toxic + clean + DOUBT)


def fit(
    docs: DataFrame, labels: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Classifier:
    """Learn the features that tell, then how much their evidence counts in a text of so many words."""
    spark = docs.sparkSession
    ship(spark)
    known = labels.select(F.col(id_col).alias("l_id"), F.col(label_col).alias("y"))
    known = hash_sample(known.filter(F.col("y").isin(0, 1) & F.col("l_id").isNotNull() & ~held_out(F.col("l_id"))).distinct(), FIT_ROWS, "l_id", "y")
    known = F.broadcast(known)  # an id and a label for at most FIT_ROWS rows
    rows = docs.select(id_col, text_col).join(known, F.col(id_col) == F.col("l_id")).select("l_id", "y", text_col)
    shared = spark.sparkContext.broadcast(model.tobytes())

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = _restorer(shared.value)
        for b in small(batches):
            words = [" ".join(r.restore(t.as_py())) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(words, pa.string())], names=["l_id", "y", "words"])

    restored = rows.mapInArrow(restore, T.StructType([rows.schema["l_id"], rows.schema["y"], T.StructField("words", T.StringType())]))
    # One text for each label, however many rows have its id.
    rows = stash(restored.groupBy("l_id", "y").agg(F.min("words").alias("words")).select(F.col("y").cast("int").alias("y"), "words"), "toxicity-rows")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            found = set()
            for words in b.column(1).to_pylist():
                before, first = "", {}
                for w in words.split():
                    for f in features(w):
                        first.setdefault(f, before)
                    before = w
                found.update((f, zlib.crc32(left.encode("utf-8"))) for f, left in first.items())
            f, left = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(left, pa.int64())], names=["feature", "left"])

    toxic = rows.filter("y = 1").mapInArrow(contexts, "feature string, left long").distinct()
    held = toxic.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_EVIDENCE)
    held = dict(held.collect())  # of the toxic ones of FIT_ROWS texts
    wanted = spark.sparkContext.broadcast(frozenset(held))

    def clean_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for b in small(batches):
            for words in b.column(1).to_pylist():
                total.update({f for w in set(words.split()) for f in features(w)} & wanted.value)
        yield pa.RecordBatch.from_arrays([pa.array([*total], pa.string()), pa.array([*total.values()], pa.int64())], names=["feature", "n"])

    clean = rows.filter("y = 0").mapInArrow(clean_texts, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    clean = dict(clean.collect())  # of the features held
    evidence = {f: (n, clean.get(f, 0)) for f, n in held.items() if chance(n, clean.get(f, 0)) >= TELLING}
    telling = spark.sparkContext.broadcast(Classifier(evidence, (0.0, 0.0, 0.0)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            y = b.column(0).to_pylist()
            words = [w.split() for w in b.column(1).to_pylist()]
            t = telling.value
            x = [t.weigh(w, lambda word, own=own: t.tells(word, own)) for w, own in zip(words, y, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.float64()), pa.array(map(len, words), pa.int64())], names=["y", "x", "n"])

    got = rows.mapInArrow(weigh, "y int, x double, n long").toPandas()  # at most a row for each label
    got = got.sort_values(["y", "x", "n"])
    return Classifier(evidence, logistic(got["y"].to_numpy(float), got["x"].to_numpy(float), got["n"].to_numpy(float)))


def logistic(y: np.ndarray, x: np.ndarray, n: np.ndarray) -> tuple[float, float, float]:
    """Weights of 1, x and log(1 + n), by Newton's method with a small ridge; without both labels the base score."""
    base = log(BASE_SCORE / (1 - BASE_SCORE))
    if not len(y) or y.min() == y.max():
        return base, 0.0, 0.0
    rows = np.stack([np.ones(len(y)), x, np.log1p(n)], axis=1)
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        step = np.linalg.solve((rows * (p * (1 - p))[:, None]).T @ rows + ridge, rows.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, w))


def score(docs: DataFrame, model: np.ndarray, classifier: Classifier, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with score and predicted (1 at `threshold` or more)."""
    spark = docs.sparkSession
    ship(spark)
    shared, told = spark.sparkContext.broadcast(model.tobytes()), spark.sparkContext.broadcast(classifier)
    src = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    at = src.columns.index(text_col)
    out = T.StructType([*src.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, judge = _restorer(shared.value), told.value
        tells = BoundedCache(judge.tells, CACHE_WORDS).__getitem__
        for b in small(batches):
            scores = [judge.score(r.restore(t.as_py()), tells) for t in b.column(at)]
            predicted = [int(s >= threshold) for s in scores]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64()), pa.array(predicted, pa.int32())], names=out.names)

    return src.mapInArrow(run, out)


def learn_and_score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with score and predicted, by a language model of all of them and their labels."""
    model = language_model(docs, text_col)
    return score(docs, model, fit(docs, labels, model, id_col, text_col), text_col, threshold)
