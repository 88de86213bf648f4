"""Quality rules, periodic runs and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from listenlab.llm import periodic_runs, quality, registry, spelling
from listenlab.llm.common import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


# --- quality rules ---


def brute_counts(text):
    text = text or ""
    words = WORDS(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(WORDS(line))
        seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    held = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(held)


@pytest.mark.parametrize("text", [None, "", " \n\t", "a a a a", "x y z x y z", "a\n\na\na b\n\n", "#a *$ é|<>\n#a *$ é|<>", "q " * 99])
def test_counts(text):
    assert quality.counts(text) == brute_counts(text)


def brute_places(text):
    """Every feature by itself, hashed with Python's integers."""
    code, mask, out = [ord(c) for c in text], (1 << 32) - 1, Counter()
    place = lambda h: (h * 0x9E3779B1 & mask) >> (32 - quality.BITS)
    for k in range(1, quality.CHARS + 1):
        for i in range(len(code) - k + 1):
            h = 0
            for j in range(k):
                h = (h * 0x01000193 + code[i + j] + j + 1) & mask
            out[place(h)] += 1
    hashes = []
    for w in WORDS(text):
        h, power = 0, 1
        for c in w.translate(LOWER)[: quality.WORD_CHARS]:
            power = power * 0x85EBCA6B & mask
            h = (h + ord(c) * power) & mask
        hashes.append(h)
    out.update(place(h + 7) for h in hashes)
    out.update(place((a * 0x01000193 + b + 11) & mask) for a, b in zip(hashes, hashes[1:], strict=False))
    return out


@pytest.mark.parametrize("text", ["", "a", " A", "Ab ab\x0bé \U0001f600 ", "one two  three\nfour " * 30, "long" * 50 + " end " + "z" * 33])
@pytest.mark.parametrize("piece", [1 << 18, 7, 1])
def test_places(monkeypatch, text, piece):
    monkeypatch.setattr(quality, "PIECE", piece)
    if piece < 1 << 18 and any(len(w) > quality.WORD_CHARS for w in WORDS(text)):
        pytest.skip("a pair's second word may lie beyond the piece's reach")
    got = Counter(int(x) for part in quality.places(text) for x in part)
    assert got == brute_places(text)


def test_quality_edges(spark, edge_docs, no_docs):
    docs = edge_docs.withColumns({"quality": F.lit("own"), "kept": F.lit(1)})
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (99, 0)], "doc_id long, quality int")
    out = quality.learn_and_judge(docs, labels)
    assert sorted(out.columns) == sorted({*docs.columns, *quality.COLUMNS})
    for r in out.collect():
        assert tuple(r[c] for c in quality.COUNTS) == brute_counts(r.text if len(r.text or "") < 1000 else None) or len(r.text) > 1000
        assert r.quality > 0.99 and r.kept == (not r.base_failed)  # nothing is learnt from one label
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert quality.learn_and_judge(no_docs, labels.limit(0)).count() == 0


@pytest.fixture(scope="module")
def judged(spark, sf_mid):
    return registry.QUERIES["op11_quality"](spark, sf_mid).cache()


def test_quality_counts_of_the_table(spark, sf_mid, judged):
    texts = {r.doc_id: r.text for r in table(spark, sf_mid, "documents").select("doc_id", "text").collect()}
    rows = {r.doc_id: r for r in judged.collect()}
    assert rows.keys() == texts.keys()
    for i, r in rows.items():
        if len(texts[i] or "") < 3000:
            assert tuple(r[c] for c in quality.COUNTS) == brute_counts(texts[i])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.quality >= quality.KEEP)


def test_quality_held_out(spark, sf_mid, judged):
    labels = table(spark, sf_mid, "labels").select("doc_id", F.col("quality").alias("y"))
    rows = judged.join(labels, "doc_id").filter(quality.held_out(F.col("doc_id")) & ~F.col("base_failed"))
    right = {(r.y, r.kept): r.n for r in rows.groupBy("y", "kept").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = (right.get((y, True), 0) / (right.get((y, True), 0) + right.get((y, False), 0)) for y in (1, 0))
    assert good >= 0.97 and bad <= 0.1
    chances = rows.agg(F.avg("quality").alias("p"), F.avg("y").alias("y")).first()
    assert abs(chances.p - chances.y) < 0.1  # calibrated


# --- periodic runs ---


def brute_runs(words, least=12):
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, 2 * p):
                out.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in out.items())


def random_words(rng):
    n, kinds = rng.choice([0, 1, 5, 12, 13, 30, 80, 200]), rng.choice([1, 2, 3, 10])
    words = [rng.choice("abcdefghij"[:kinds]) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 2))
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("bound", [1 << 19, 3])
def test_runs_of_random_words(monkeypatch, bound):
    monkeypatch.setattr(periodic_runs, "CANDIDATES", bound)
    rng = random.Random(1)
    for _ in range(120):
        texts, least = [random_words(rng) for _ in range(rng.randint(1, 8))], rng.choice([12, 12, 3, 2])
        got = periodic_runs.find_runs(texts, least)
        assert [[tuple(r) for r in g.tolist()] for g in got] == [brute_runs(w, least) for w in texts]


def test_long_grids(monkeypatch):
    monkeypatch.setattr(periodic_runs, "GRID", 16)
    monkeypatch.setattr(periodic_runs, "_grid", [])
    rng = random.Random(2)
    for _ in range(40):
        w = random_words(rng)
        assert [tuple(r) for r in periodic_runs.find_runs([w])[0].tolist()] == brute_runs(w)
    assert {(m, p) for m, p in zip(*map(list, periodic_runs.grid_pairs(5, 40)), strict=True)} == {(m, p) for m in range(5, 40) for p in range(1, 40) if m % p == 0}


def test_a_long_text_of_one_word():
    assert periodic_runs.find_runs([["a"] * 100_000])[0].tolist() == [[0, 100_000, 1]]


def brute_periodic(doc_id, text):
    words = WORDS(text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join("%d,%d,%d\n" % r for r in runs)), sha(kept))


def test_periodic_query(spark, sf_small):
    docs = table(spark, sf_small, "documents").filter("length(text) < 6000 or text is null")
    got = registry.QUERIES["op12_periodic_runs"](spark, sf_small).collect()
    want = {r.doc_id: brute_periodic(r.doc_id, r.text) for r in docs.collect()}
    assert {r.doc_id: tuple(r) for r in got if r.doc_id in want} == want
    assert sum(r.n_runs > 0 for r in got) > 5 and len(got) == table(spark, sf_small, "documents").count()


def test_periodic_edges(spark, edge_docs, no_docs):
    docs = edge_docs.withColumn("runs", F.lit("own")).unionByName(
        spark.createDataFrame([(i, f"{'the same ' * 7}end {i}") for i in (*range(40), None)], "doc_id long, text string"), allowMissingColumns=True
    )
    out = periodic_runs.periodic_runs(periodic_runs.plant(docs))
    assert sorted(out.columns) == sorted({*docs.columns, "n_words", "runs", "collapsed"})
    rows = [r for r in out.collect() if len(r.text or "") < 1000]
    for r in rows:
        words = WORDS(r.text or "")
        assert [tuple(x) for x in r.runs] == brute_runs(words) and r.n_words == len(words)
    planted = periodic_runs.plant(docs).select("doc_id", "text").collect()
    for (i, before), (_, after) in zip([tuple(r) for r in docs.select("doc_id", "text").collect()], planted, strict=True):
        assert len(WORDS(before or "")) == len(WORDS(after or ""))
        if i is None:
            assert before == after
    assert periodic_runs.periodic_runs(no_docs).count() == 0


# --- spelling variants ---


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute_vocabulary(rows, spoil=199):
    total = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and spoil and h % spoil == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def brute_variants(words):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    best = {w: min(x, key=lambda y: (-words[y], y)) if x else None for w, x in near.items()}
    form = {w: b if b and words[b] >= 5 * words[w] else None for w, b in best.items()}
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), form[w] and words[form[w]]))
    return out


def test_near_pairs():
    rng = random.Random(3)
    for _ in range(500):
        n, kinds = rng.randint(0, 6), rng.choice(["a", "ab", "abé"])
        words = sorted({"".join(rng.choices(kinds, k=n + rng.randint(0, 1))) for _ in range(30)})
        want = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])}
        got = list(spelling.near_pairs(words))
        assert {(i, j) for i, j, _ in got} == want and len(got) == len(want)
        assert all(words[i][:d] == words[j][:d] and words[i][d : d + 1] != words[j][d : d + 1] for i, j, d in got)


@pytest.mark.parametrize("most", [4096, 2])
def test_variants(spark, most):
    rng = random.Random(4)
    words = {"".join(rng.choices("abé", k=rng.randint(5, 8))): rng.choice([5, 5, 6, 26, 130, 651]) for _ in range(700)}
    words |= {"hot" + x + y: 7 for x in "abcdefghij" for y in "klmnopqrst"} | {"z" * 300: 5, "z" * 301: 25, "z" * 299 + "y": 125}
    df = spark.createDataFrame([*words.items()], "word string, n long")
    assert {tuple(r) for r in spelling.variants(df, block_words=most).collect()} == brute_variants(words)


def test_blocks_are_bounded(spark):
    # All words of a large block share their first half.
    df = spark.createDataFrame([(f"prefixes{a}{b}{c}", 5) for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"], "word string, n long")
    sizes = spelling._bounded(df, 20).groupBy(*spelling.BLOCK).count()
    assert sizes.filter("count > 20 and high - low > 1").count() == 0
    assert sizes.agg(F.max("count")).first()[0] <= 8 + 8 * 8
    assert {r.n_near for r in spelling.near_words(df, 20).collect()} == {21}


def test_spelling_query(spark, sf_small):
    docs = table(spark, sf_small, "documents").select("doc_id", "text")
    got = registry.QUERIES["op13_spelling"](spark, sf_small)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    words = brute_vocabulary([tuple(r) for r in docs.collect()])
    assert {tuple(r) for r in got.collect()} == brute_variants(words)


def test_spelling_edges(spark, edge_docs, no_docs):
    more = [(i, "Wörterbuch WÖRTERBUCH wörterbuch") for i in (20, 21, 22, 22, None)] + [(30, "Wörterbücher " * 9), (None, "wörterbuchs " * 60)]
    docs = edge_docs.withColumns({"word": F.lit("own"), "n": F.lit(1)}).unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    words = brute_vocabulary([tuple(r) for r in docs.select("doc_id", "text").collect()])
    for spoil in (0, 2):
        got = {r.word: r.n for r in spelling.vocabulary(docs, spoil=spoil).collect()}
        assert got == brute_vocabulary([tuple(r) for r in docs.select("doc_id", "text").collect()], spoil)
    assert {tuple(r) for r in spelling.variants(spelling.vocabulary(docs, spoil=199)).collect()} == brute_variants(words)
    assert spelling.variants(spelling.vocabulary(no_docs)).count() == 0
