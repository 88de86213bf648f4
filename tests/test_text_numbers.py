"""Column expressions: literal tables of texts, and number texts against Python's own formatting."""

from __future__ import annotations

import random
import struct

import pytest
from pyspark.sql import functions as F

from listenlab.functions.numbers import coerce_numeric
from listenlab.functions.text import capitalize_sentences, mis_encode, repair_columns, repair_text


# Each row: the text as stored, what the dashboard's rules make of it, what the strict repair makes of it.
REPAIRS = [
    (None, None, None),
    ("", "", ""),
    ("Sia", "Sia", "Sia"),
    ("What?", "What?", "What?"),
    # correct accents
    ("Björk", "Björk", "Björk"),
    ("’tis", "’tis", "’tis"),
    ("日本", "日本", "日本"),
    # one layer: the dashboard's rules damage what is Latin-1 after one step, and keep what is not
    ("BeyoncÃ©", "Beyonc\ufffd", "Beyoncé"),
    ("Beyonc\xc3\xa9?", "Beyonc\xc3\xa9?", "Beyoncé?"),
    ("\xe2\x80\x99tis", "\xe2\x80\x99tis", "’tis"),
    ("\xe6\x97\xa5\xe6\x9c\xac", "\xe6\x97\xa5\xe6\x9c\xac", "日本"),
    # two layers
    ("Beyonc\xc3\x83\xc2\xa9", "Beyoncé", "Beyoncé"),
    ("Beyonc\xc3\x83\xc2\xa9?", "Beyonc\xc3\x83\xc2\xa9?", "Beyoncé?"),
    ("\xc3\xa2\xc2\x80\xc2\x99tis", "’tis", "’tis"),
    # three layers: two are taken off
    ("\xc3\x83\xc2\x83\xc3\x82\xc2\xa9", "\xc3\xa9", "\xc3\xa9"),
    # bytes that are no whole UTF-8 sequence
    ("Ã", "Ã", "Ã"),
    ("Â\x80", "\ufffd", "\x80"),
    ("ðŸ˜€", "ðŸ˜€", "ðŸ˜€"),
    ("\xf0\x9f\x98\x80", "\xf0\x9f\x98\x80", "😀"),
]


@pytest.mark.parametrize(("mode", "at"), [("compat", 1), ("strict", 2)])
def test_repair(spark, mode, at):
    df = spark.createDataFrame([(i, r[0], r[0]) for i, r in enumerate(REPAIRS)], "i int, s string, t string")
    want = {i: r[at] for i, r in enumerate(REPAIRS)}
    assert {r.i: r.r for r in df.select("i", repair_text(F.col("s"), mode).alias("r")).collect()} == want
    both = repair_columns(df, ["s", "t"], mode)
    assert both.columns == df.columns
    assert {r.i: (r.s, r.t) for r in both.collect()} == {i: (w, w) for i, w in want.items()}
    both.write.format("noop").mode("overwrite").save()
    assert "*(1) Project" in both._jdf.queryExecution().executedPlan().toString()


def test_mis_encode(spark):
    df = spark.createDataFrame([("é’a",)], "s string")
    got = df.select(*(mis_encode(F.col("s"), k) for k in (0, 1, 2))).first()
    assert tuple(got) == ("é’a", "\xc3\xa9\xe2\x80\x99a", "\xc3\x83\xc2\xa9\xc3\xa2\xc2\x80\xc2\x99a")


CAPITALS = [
    ("", ""),
    ("one two. three", "One Two. Three"),
    ("McCartney and the beatles", "McCartney And The Beatles"),
    ("NASA's b2b x-ray", "NASA's B2b X-ray"),
    ("  two  spaces\tand\ttabs ", "Two Spaces And Tabs"),
    ("end.no space. yes", "End.no Space. Yes"),
    ("a. . b", "A. . B"),
    ("élan über straße ßa", "Élan Über Straße Ssa"),
    ("ǆ 1a 日本 ж", "ǅ 1a 日本 Ж"),
    ("x\u2003y\u3000z", "X Y Z"),
]


def test_capitalize_sentences(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CAPITALS)], "i int, s string")
    got = {r.i: r.c for r in df.select("i", capitalize_sentences(F.col("s")).alias("c")).collect()}
    assert got == {i: c for i, (_, c) in enumerate(CAPITALS)}


def test_round_trip_documents(spark, sf_mid):
    docs = spark.read.parquet(f"{sf_mid}/documents.parquet").select("doc_id", "text")
    for layers in (1, 2):
        g = docs.select("text", mis_encode(F.col("text"), layers).alias("g"))
        bad = g.where(repair_text(F.col("g"), "strict") != F.col("text")).count()
        assert bad == 0
    g2 = docs.select("text", mis_encode(F.col("text"), 2).alias("g"))
    assert g2.where(repair_text(F.col("g"), "compat") != F.col("text")).count() == 0


def _doubles(n, seed):
    rnd = random.Random(seed)
    vals = [0.0, 0.5, 1.5, 2.5, 3.5, 0.25, 0.35, 0.45, 0.125, 1.005, 2.675, 1e15 + 0.5, 123456.5, 99.95, 66.66666666666667]
    vals += [k / 20 for k in range(0, 400)] + [k / 8 for k in range(0, 200)]
    for _ in range(n):
        r = rnd.random()
        if r < 0.3:
            vals.append(rnd.uniform(0, 100))
        elif r < 0.6:
            vals.append(rnd.randint(0, 10**6) / rnd.choice([2, 4, 10, 20, 60, 100, 1000]))
        else:
            bits = rnd.getrandbits(62)
            v = struct.unpack("<d", struct.pack("<Q", bits))[0]
            if v == v and abs(v) < 1e12:
                vals.append(abs(v))
    vals += [-0.25, -1.5, -2.675]
    return vals


def test_coerce_numeric(spark):
    vals = ["1", " 12 ", "1e3", "-2.5", "n/a", "", "1.5d", "2f", "inf", "abc", None, "0x1p3", "+4"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(coerce_numeric(F.col("s"))).collect()]
    assert got == [1.0, 12.0, 1000.0, -2.5, None, None, None, None, float("inf"), None, None, None, 4.0]


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_py_text_sql_form_matches_python(spark, digits):
    from listenlab.functions.numbers import py_text

    vals = _doubles(3000, digits + 10) + [1e300, -1e19, 5e18]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = {r.i: r.t for r in df.select("i", py_text("x", digits).alias("t")).collect()}
    exact = [(v, got[i]) for i, v in enumerate(vals) if abs(v) * 10**digits < 9e18]
    bad = [(v, g, format(v, f".{digits}f")) for v, g in exact if g != format(v, f".{digits}f")]
    assert not bad, bad[:5]
    sp = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    assert [r[0] for r in sp.select(py_text("x", digits)).collect()] == [None, "nan", "inf", "-inf"]


def test_coerce_numeric_matches_pandas(spark):
    import math

    import pandas as pd

    vals = ["1", " 12 ", "1e3", "-2.5", "n/a", "", "1.5d", "2f", "inf", "-inf", "Infinity", "-Infinity", "nan",
            "NaN", "abc", None, "0x1p3", "+4", "1_000", "1,000", ".5", "5.", "1e", "e5", "1e+5", "1E-5", "  ",
            "\t3\n", "0012", "-0", "+-1", "3.14abc", "INF", "inFinity", "NAN", "1.7976931348623157e309", "-1e999",
            "4.9e-325", "0.1", "123456789012345678901234567890"]
    expect = pd.to_numeric(pd.Series(vals, dtype=object), errors="coerce").tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    got = {r.i: r.v for r in df.select("i", coerce_numeric(F.col("s")).alias("v")).collect()}

    def missing(x):
        return x is None or (isinstance(x, float) and math.isnan(x))

    for i, v in enumerate(vals):
        e, g = expect[i], got[i]
        assert missing(e) == missing(g) and (missing(e) or float(e) == float(g)), (v, e, g)


def test_py_round_text_matches_python_round(spark):
    from listenlab.functions.numbers import py_round_text

    vals = [0.5, 1.5, 2.5, -0.4, -0.5, -1.5, -2.5, 1234.5, 0.49999999999999994, 7.0, -7.0] + _doubles(500, 3)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = {r.i: r.t for r in df.select("i", py_round_text("x").alias("t")).collect()}
    bad = [(v, got[i], str(round(v))) for i, v in enumerate(vals) if got[i] != str(round(v))]
    assert not bad, bad[:5]


def _compat_rules(s: str) -> str:
    """The rules of `repair_text(mode="compat")`, byte by byte."""

    def step(x):
        try:
            return x.encode("latin-1").decode("utf-8", "replace")
        except UnicodeEncodeError:
            return None

    once = step(s)
    if once is None or once == s or "?" in once:
        return s
    twice = step(once)
    if twice is None:
        return s
    return twice if twice != once and "?" not in twice else once


def test_repair_compat_of_random_bytes(spark):
    rnd = random.Random(11)
    some = [0x41, 0x3F, 0x80, 0x8F, 0x9F, 0xA0, 0xBF, 0xC2, 0xC3, 0xDF, 0xE0, 0xE2, 0xED, 0xF0, 0xF4, 0xFF]
    texts = ["".join(map(chr, rnd.choices([*some, 0x263A], k=rnd.randint(0, 8)))) for _ in range(3000)]
    texts += [t.encode().decode("latin-1") for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    assert {r.i: r.s for r in repair_columns(df, ["s"], "compat").collect()} == {i: _compat_rules(t) for i, t in enumerate(texts)}


def test_capitalize_random_words(spark):
    rnd = random.Random(12)
    words = ["".join(rnd.choices("abzABZéÉßǆǅİ1'-", k=rnd.randint(1, 4))) for _ in range(3000)]
    words += ["".join(rnd.choices("abé1-", k=3)) for _ in range(3000)]  # many pieces without a capital inside a word
    texts = ["".join(w + rnd.choice([" ", ". ", "\n", "  ", ".", " . "]) for w in rnd.sample(words, rnd.randint(1, 6))) for _ in range(2000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    want = {i: ". ".join(" ".join(w.capitalize() if w.islower() else w for w in p.split()) for p in t.split(". ")) for i, t in enumerate(texts)}
    assert {r.i: r.c for r in df.select("i", capitalize_sentences(F.col("s")).alias("c")).collect()} == want
