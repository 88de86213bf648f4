"""Line dedup, SimHash, BPE, token counts and toxicity against brute force."""

from __future__ import annotations

import base64
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from listenlab.llm import bpe, graph, line_dedup, registry, simhash, token_counts, toxicity
from listenlab.llm.common import table
from oracle_compare import compare, duck

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- line dedup ---


def brute_lines(docs, min_chars=40, min_docs=5, key=None):
    holders = defaultdict(set)
    none_first = key or (lambda i: (i is not None, i or 0))
    key = lambda line: line.strip(SPACE).translate(LOWER)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    keep = {k: max(v, key=none_first) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keep or keep[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_line_dedup_edges(spark, edge_docs, no_docs):
    line = "  Every ONE of these documents has this line é\t"
    more = spark.createDataFrame([(i, f"{line}\nown {i}\n{line.lower()}") for i in (10, 11, 12, 13, None)], "doc_id long, text string")
    docs = edge_docs.unionByName(more, allowMissingColumns=True)
    for batches in (1, 3):
        got = line_dedup.dedup_lines(docs, batches=batches)
        rows = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect())
        assert rows == brute_lines(texts_of(docs))
    assert set(got.columns) == {*docs.columns, "n_dropped"}
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_line_dedup_of_rows_without_an_id(spark):
    lines = [f"a line that is long enough to be a key, {i:03d} of some" for i in range(40)]
    rng = random.Random(7)
    rows = [(None if i % 3 == 0 else i, "\n".join([f"own {i}", *rng.sample(lines, 6)])) for i in range(90)] + [(None, None), (None, "")] + [(None, lines[0])] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for shown in (docs, docs.withColumn("doc_id", F.format_string("id-%05d", "doc_id"))):
        given = texts_of(shown)
        key = (lambda i: (i is not None, i or 0)) if shown is docs else (lambda i: (i is not None, i or ""))
        got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.dedup_lines(shown).collect())
        assert got == brute_lines(given, key=key)


def test_line_dedup_moves_only_rows_that_lose_lines(spark, tmp_path, monkeypatch):
    shared = "this very line is found in many of the documents"
    docs = spark.createDataFrame([(i, f"own {i}\n" + (shared if i % 10 == 0 else "")) for i in range(2000)], "doc_id long, text string")
    out = line_dedup.dedup_lines(docs)
    rows = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect())
    assert rows == brute_lines(texts_of(docs))
    monkeypatch.setattr(line_dedup, "FILTER_BITS", 64)  # a filter that lets all through changes nothing
    again = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.dedup_lines(docs).collect())
    assert again == rows
    bits = np.unpackbits(line_dedup._filter(spark.createDataFrame([(1, 2), (1, 2)], "r1 long, r2 long")), bitorder="little")
    assert len(bits) == 64 and 1 <= bits.sum() <= line_dedup.FILTER_SETS


def test_line_dedup_leaves_no_tables(spark, edge_docs):
    before = {t.name for t in spark.catalog.listTables()}
    line_dedup.dedup_lines(edge_docs).count()
    assert {t.name for t in spark.catalog.listTables()} == before
    warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    assert not os.path.isdir(warehouse) or not [x for x in os.listdir(warehouse) if "line_runs" in x]


def test_line_dedup_oracle(spark, sf_mid):
    got = compare(spark, sf_mid, ["op2_line_dedup"], con=duck(sf_mid))
    assert got["op2_line_dedup"][0] == "ok", got


def test_sorted_runs_merge_and_compact(spark):
    runs = line_dedup.SortedRuns(spark, buckets=3, fan_in=2)
    seen = Counter()
    for b in range(5):
        batch = [(h, -h, 1, 100 - b) for h in range(b, b + 20)]
        df = spark.createDataFrame(batch, "h1 long, h2 long, n_docs long, holder long")
        assert {r.h1 for r in runs.first_seen(df).collect()} == {h for h, *_ in batch if h not in seen}
        runs.add(df)
        seen.update(h for h, *_ in batch)
    assert len(runs._runs()) <= 3
    got = {r.h1: (r.n_docs, r.holder) for r in runs.merged().collect()}
    assert got == {h: (n, 100 - max(0, h - 19)) for h, n in seen.items()}
    runs.drop()


# --- SimHash ---


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode("utf-8"), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(fps, bits=3):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    distinct = list(parent)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    return {f: find(f) for f in distinct}


@pytest.mark.parametrize("text", ["", None, "a", "A b", "a  b\tC d", "É É é", "x " * 5000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("hot", [4096, 3])
def test_links_of_clustered_fingerprints(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_CELL", hot)
    rnd = random.Random(hot)
    fps = {0, (1 << 64) - 1}
    for _ in range(40):
        centre = rnd.getrandbits(64)
        for _ in range(12):
            f = centre
            for _ in range(rnd.randint(0, 4)):
                f ^= 1 << rnd.randrange(64)
            fps.add(f)
    points = spark.createDataFrame([(signed(f),) for f in sorted(fps)], "fp long")
    links = simhash.linked(points)
    assert all(((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= 3 for r in links.collect())
    found = {r.node: r.component for r in graph.components(links).collect()}
    groups = brute_groups(fps)
    smallest = defaultdict(list)
    for f, g in groups.items():
        smallest[g].append(signed(f))
    assert {signed(f): found.get(signed(f), signed(f)) for f in fps} == {signed(f): min(smallest[g]) for f, g in groups.items()}


def test_groups_of_near_fingerprints_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_CELL", 20)
    # All share 52 bits and most of their cells.
    fps = [0x5A5A5A5A5A5A5000 | i for i in range(0, 4096, 5)]
    points = spark.createDataFrame([(f,) for f in fps], "fp long")
    met = simhash.cells(points)
    n = met.groupBy("half", "cell").agg(F.count(F.lit(1)).alias("n"))
    rows = met.join(n, ["half", "cell"]).select("half", "cell", "fp", "n").withColumns({"mask": F.lit(0).cast("long"), "value": F.lit(0).cast("long")})
    sizes = simhash._bounded(rows).groupBy(*simhash.GROUP).agg(F.countDistinct("fp").alias("n"), F.first("mask").alias("m")).collect()
    assert max(r.n for r in sizes) <= 20 or all(r.n <= 20 or bin(r.m & (1 << 64) - 1).count("1") >= 64 - simhash.FREE_BITS for r in sizes)
    links = {(r.a, r.b) for r in simhash.linked(points).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    groups, found = brute_groups(fps), brute_groups_of(fps, links)
    assert len({*groups.values()}) == len({*found.values()}) and all((groups[a] == groups[b]) == (found[a] == found[b]) for a, b in zip(fps, fps[1:], strict=False))
    for mask in (0, *simhash._parts(0)):
        parts = simhash._parts(mask)
        assert all(p & mask == mask for p in parts) and parts[0] | parts[1] | parts[2] | parts[3] == (1 << 64) - 1


def brute_groups_of(fps, links):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_near_duplicates(spark, sf_small, edge_docs, no_docs):
    near = table(spark, sf_small, "documents").select("doc_id", "text")
    near = near.unionByName(near.filter("doc_id % 3 = 0").select((F.col("doc_id") + 1000).alias("doc_id"), F.concat("text", F.lit(" end")).alias("text")))
    for docs in (near, edge_docs):
        rows = texts_of(docs)
        fps = {t: brute_fingerprint(t) for _, t in rows}
        groups = brute_groups(fps.values())
        first = {}
        for i, t in rows:
            g = groups[fps[t]]
            first[g] = min(first.get(g, i), i) if None not in (i, first.get(g, i)) else i if first.get(g) is None else first[g]
        want = Counter((i, format(fps[t], "016x"), first[groups[fps[t]]]) for i, t in rows)
        assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want
        kept = simhash.keep_first(docs)
        assert kept.columns == docs.columns
        assert Counter(groups[fps[t]] for _, t in texts_of(kept)) == Counter(set(groups.values()))
    assert simhash.near_duplicates(no_docs).count() == 0 == simhash.keep_first(no_docs).count()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (2001, 2000)], "a long, b long")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 2000: 2000, 2001: 2000}


# --- BPE and token counts ---


@pytest.fixture(scope="module")
def known():
    with open(registry.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=registry.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.tokenizer(registry.RANKS, registry.PATTERN)


def random_texts(n):
    rnd = random.Random(n)
    letters = "abcdeetaoinshr  \n\t'.,0123é日ñß\U0001f600\x00\x1c\xa0　"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


def test_encode_as_tiktoken(tokenizer, known):
    for text in [*random_texts(3000), "a" * 5000, "\n" * 3000, "'ll I'LL  x", "ß" * 500]:
        ids = tokenizer.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == known.encode_ordinary(text), repr(text)
        assert tokenizer.decode(ids) == text.encode("utf-8")


def test_prefix_table_appends_and_edits(tokenizer, known):
    rnd = random.Random(5)
    v = tokenizer.vocabulary
    words = "".join(random_texts(400)).split() + ["thequickbrownfoxjumpsoverthelazydog" * 3]
    for w in words[-60:]:
        data = w.encode("utf-8")
        cut = rnd.randint(0, len(data))
        table_ = bpe.PrefixEncoder(v, data[:cut])
        table_.append(data[cut:])
        assert table_.last == bpe.PrefixEncoder(v, data).last
        a, b = sorted((rnd.randint(0, len(data)), rnd.randint(0, len(data))))
        new = bytes(rnd.choice(b"aehtnr") for _ in range(rnd.randint(0, 4)))
        table_.replace(a, b, new)
        fresh = bpe.PrefixEncoder(v, data[:a] + new + data[b:])
        assert (table_.data, table_.last) == (fresh.data, fresh.last)
        assert b"".join(v.bytes_of[i] for i in fresh.ids()) == fresh.data
    long = bpe.PrefixEncoder(v, b"internationalisation" * 200)
    assert long.replace(100, 101, b"x") < 400


def test_digests_and_round_trip(spark, sf_small, edge_docs, no_docs, known):
    for docs in (edge_docs, table(spark, sf_small, "documents")):
        want = Counter()
        for i, t in texts_of(docs):
            ids = known.encode_ordinary(t or "")
            want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
        assert Counter(map(tuple, bpe.digests(docs, registry.RANKS, registry.PATTERN).collect())) == want
    encoded = bpe.encode(edge_docs, registry.RANKS, registry.PATTERN)
    assert set(encoded.columns) == set(edge_docs.columns)
    back = bpe.decode(encoded, registry.RANKS, registry.PATTERN).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() and len(r.token_ids) == r.n_tokens for r in back)
    assert bpe.encode(no_docs, registry.RANKS, registry.PATTERN).count() == 0


def test_token_counts(spark, edge_docs, no_docs, known):
    docs = edge_docs.select("text", "lang")
    hist = token_counts.length_histogram(docs, registry.RANKS, registry.PATTERN, group_cols=("lang",))
    sums = token_counts.suffix_sums(hist, ("lang",))
    lengths = defaultdict(list)
    for r in docs.collect():
        lengths[r.lang].append(len(known.encode_ordinary(r.text or "")))
    rows = sums.collect()
    assert {(r.lang, r.n_tokens) for r in rows} == {(g, n) for g, ns in lengths.items() for n in ns}
    for r in rows:
        ns, n = lengths[r.lang], r.n_tokens
        longer = [x for x in ns if x >= n]
        assert (r.documents, r.documents_at_least, r.tokens_at_least) == (ns.count(n), len(longer), sum(longer))
        assert (r.truncated_total, r.total) == (sum(min(x, n) for x in ns), sum(ns))
    got = {(r.lang, r.q): r.n_tokens for r in token_counts.quantiles(sums, [0, 0.5, 1], ("lang",)).collect()}
    for g, ns in lengths.items():
        ns = sorted(ns)
        assert [got[g, q] for q in (0.0, 0.5, 1.0)] == [ns[0], ns[-(-len(ns) // 2) - 1], ns[-1]]
    cut = {(r.lang, r.limit): r.tokens for r in token_counts.truncated_totals(hist, [0, 3, 10**6], ("lang",)).collect()}
    assert cut == {(g, m): sum(min(x, m) for x in ns) for g, ns in lengths.items() for m in (0, 3, 10**6)}
    assert token_counts.suffix_sums(token_counts.length_histogram(no_docs, registry.RANKS, registry.PATTERN)).count() == 0


# --- toxicity ---


def brute_costs(texts):
    """4-gram counts by reading the texts symbol by symbol."""
    counts = np.zeros((28,) * 4)
    for t in texts:
        for word in re.findall(r"[a-zA-Z\u0080-\U0010ffff]+", t):
            at = (0, 0, 0)
            for c in [*word.lower(), None]:
                s = 0 if c is None else ord(c) - 96 if "a" <= c <= "z" else 27
                counts[(*at, s)] += 1
                at = (*at[1:], s)
    return counts


def test_language_model_counts():
    texts = ["The cat, the Éléphant!\nzz top", "", "idiot 1d10t", None]
    got = toxicity.ngram_counts(texts).reshape((28,) * 4)
    want = brute_costs(t for t in texts if t)
    inside = np.ones_like(want, bool)
    inside[:, :, 0, 0] = inside[0, 0, 0, 0] = False  # what stands between words
    for s in range(1, 28):
        assert (got[..., s] == want[..., s]).all()
    chances = np.exp(-toxicity.costs(got.ravel().astype(float))).reshape(-1, 28).sum(axis=1)
    assert np.allclose(chances, 1)


@pytest.fixture(scope="module")
def restorer():
    words = "you are an idiot and a loser what a stupid clown this trash is useless moron the less said the better dog cool".split()
    return toxicity.Restorer(toxicity.costs(toxicity.ngram_counts([" ".join(words * 50)]).astype(float)))


@pytest.mark.parametrize(
    ("text", "words"),
    [
        ("You 1d10t!", ["you", "idiot"]),
        ("i d i o t", ["idiot"]),
        ("you m.o.r.o.n", ["you", "moron"]),
        ("l-0-s-e-r", ["loser"]),
        ("stuuuupid cl0wn", ["stupid", "clown"]),
        ("$tupid tr@sh", ["stupid", "trash"]),
        ("useless dog, cool.", ["useless", "dog", "cool"]),
        ("", []),
        (None, []),
    ],
)
def test_restore(restorer, text, words):
    assert restorer.restore(text) == words


@pytest.mark.parametrize(
    "text",
    [
        "idio7.", "idi07,", "idio+?", "idio7_", "«idio7»", "1.d.1.0.t", '"i d i o t"', "(i d i o t)", "«i d i o t»", "[i.d.i.o.t]",
        "i    d     i    o \t  \n  t", "i/d/i/o/t", "i,d,i,o,t", "i, d, i, o, t;", "i . d . i . o . t", "'i:d:1:0:t'",
    ],
)
def test_restore_before_and_between_any_signs(restorer, text):
    assert restorer.restore(f"you {text}") == ["you", "idiot"]


@pytest.mark.parametrize(
    ("text", "words"),
    [
        ("u s e l e s s", ["useless"]), ("u.s.e.l.e.s.s", ["useless"]), ("u/s/e/l/e/s/s", ["useless"]), ("u_s_e_l_e_s_s", ["useless"]),
        ("u\u200bs\u200be\u200bl\u200be\u200bs\u200bs", ["useless"]), ("use\u00adless", ["useless"]), ("dog/cool", ["dog", "cool"]),
        ("id*ot", ["idiot"]), ("m#ron", ["moron"]), ("ｉｄｉｏｔ", ["idiot"]), ("ＩＤ１０Ｔ", ["idiot"]), ("t r a s h  c l o w n", ["trash", "clown"]),
    ],
)
def test_restore_wide_masked_and_set_apart(restorer, text, words):
    assert restorer.restore(f"you {text} and") == ["you", *words, "and"]


def test_marks_on_letters():
    known = toxicity.Classifier({"idiot$": (30, 0), "gêner$": (9, 0)}, (0.0, 1.0, 0.0))
    assert known.tells("idiót") == known.tells("idiot") > 0 == known.tells("idióts")
    assert known.tells("gêner") > 0 == known.tells("gener")


def plain_toxicity(rows, labels):
    """The whole path over {doc_id: text} in plain Python, but for the cheapest readings: scores by doc_id."""
    reader = toxicity.Restorer(toxicity.costs(brute_costs([*rows.values()]).ravel()))
    words = {i: reader.restore(t) for i, t in rows.items()}
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    known = {(i, y) for i, y in labels if y in (0, 1) and not held(i) and i in rows}
    stems = lambda w: {w + "$"} | {w[:k] for k in (4, 5, 6) if len(w) > k}
    contexts, clean = defaultdict(set), Counter()
    for i, y in known:
        seen = set()
        for k, w in enumerate(words[i]):
            new = stems(w) - seen
            seen |= new
            for f in new if y else ():
                contexts[f].add(words[i][k - 1] if k else "")
        clean.update(() if y else seen)
    evidence = {f: (len(c), clean[f]) for f, c in contexts.items() if len(c) >= 4 and len(c) / (len(c) + clean[f] + 2) >= 0.6}

    def weigh(ws, own=None):
        total = []
        for w in set(ws):
            odds = [(t - (own == 1)) / (t - (own == 1) + c - (own == 0) + 2) for t, c in (evidence[f] for f in stems(w) | {toxicity.without_marks(w) + "$"} if f in evidence)]
            total.append(math.log(max(odds) / (1 - max(odds))) if odds and max(odds) >= 0.6 else 0.0)
        return math.fsum(total)

    data = [(y, 1.0, weigh(words[i], y), math.log(1 + len(words[i]))) for i, y in sorted(known)]
    w = np.zeros(3)
    x, y = np.array([r[1:] for r in data]), np.array([r[0] for r in data], float)
    for _ in range(3000):  # Newton's method in small steps
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (y - p) - np.array([1e-3, 1e-2, 1e-2]) * w
        w += 0.2 * np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-2, 1e-2]), slope)
    return {i: 1 / (1 + math.exp(-(w @ [1.0, weigh(ws), math.log(1 + len(ws))]))) for i, ws in words.items()}


def test_toxicity_against_plain_python(spark, sf_small):
    rows = {r.doc_id: r.text for r in table(spark, sf_small, "documents").collect()}
    labels = [(r.doc_id, r.toxic) for r in table(spark, sf_small, "labels").collect()]
    want = plain_toxicity(rows, labels)
    got = registry.QUERIES["op10_toxicity"](spark, sf_small).collect()
    assert {r.doc_id for r in got} == set(want)
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-6) and r.predicted == int(r.score >= 0.7)


def test_repeated_rows_of_a_label_count_once(spark, sf_small):
    docs, labels = table(spark, sf_small, "documents").select("doc_id", "text"), table(spark, sf_small, "labels")
    model = toxicity.language_model(docs)
    once = toxicity.fit(docs, labels, model)
    label = labels.filter("toxic = 1").select("doc_id").first()[0]
    more = docs.unionByName(docs.filter(F.col("doc_id") == label).crossJoin(spark.range(50)).drop("id"))
    assert toxicity.fit(more, labels.unionByName(labels), model) == once


def test_gates_take_linear_time(restorer):
    for text in ("$ " * 50_000 + "ab", "1" * 200_000, "a" + "." * 200_000 + "1", "i d " * 50 + "ii"):
        assert isinstance(restorer.restore(text), list)


def test_long_stretches_are_read_whole(restorer):
    for shift in range(10):
        text = "x" * shift + " " + " ".join("idiot" * 400)
        assert restorer.restore(f"{text}")[-400:] == ["idiot"] * 400


def test_shortcuts_read_as_the_lattice(restorer):
    rng = random.Random(7)
    for _ in range(5_000):
        chunk = "".join(rng.choice("abeidotsñé..,-'\"*#!$013@_()2\u200b") for _ in range(rng.randint(1, 14)))
        words = re.findall(r"[^\W\d_]+", chunk)
        if words and toxicity._SUSPICIOUS.search(chunk):
            words = restorer.read(chunk).split()
        assert restorer._read_chunk(chunk).split() == words


def test_letters_set_apart_are_never_passed_over():
    rng = random.Random(8)
    for _ in range(20_000):
        text = "".join(rng.choice("ab1$é  ..,_*\n\u200b") for _ in range(rng.randint(1, 16)))
        assert not toxicity._APART.search(text) or toxicity._MAY_APART.search(f" {text}")


def test_only_words_that_cannot_tell_are_left_out():
    judge = toxicity.Classifier({"idiot$": (9, 1), "stup": (9, 1), "é$": (8, 0), "idi$": (7, 0), "abcde": (8, 1)}, (-3.0, 1.0, 0.1))
    rng = random.Random(9)
    for _ in range(5_000):
        words = ["".join(rng.choice("abcdeistupoé") for _ in range(rng.randint(1, 4))) + rng.choice(["", "idiot", "stupid", "ídi"]) for _ in range(6)]
        assert judge.weigh(words, judge.tells) == sum(sorted(map(judge.tells, set(words))))


def test_viterbi_finds_the_cheapest_reading(restorer):
    def cost(reading):
        total, at = 0.0, 0
        for c in reading + " ":
            s = 0 if c == " " else ord(c) - 96
            if s == 0:
                total, at = total + (restorer.cost[at * 28] if at else 0), 0
            else:
                total, at = total + restorer.cost[at * 28 + s], (at * 28 + s) % 28**3
        return total

    for stretch in ("1d10t", "l.0.s", "gooood", "a11", "$t0p", "b@d.d0g"):
        readings = [("", 0.0)]
        for options in restorer.lattice(stretch):
            readings = [(r + o, c + p) for r, c in readings for o, p in options]
        best = min(cost(r) + c for r, c in readings)
        read = restorer.read(stretch)
        assert min(cost(r) + c for r, c in readings if r.split() == read.split()) == pytest.approx(best)


def test_toxicity_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (6, 1), (6, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    got = toxicity.learn_and_score(edge_docs, labels)
    assert set(got.columns) == set(edge_docs.columns)
    rows = got.collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    no_labels = labels.limit(0)
    assert {round(r.score, 6) for r in toxicity.learn_and_score(edge_docs, no_labels).collect()} == {toxicity.BASE_SCORE}
    assert toxicity.learn_and_score(no_docs, labels).count() == 0


def test_toxicity_held_out(spark, sf_mid):
    scored = registry.QUERIES["op10_toxicity"](spark, sf_mid)
    rows = scored.join(table(spark, sf_mid, "labels"), "doc_id").filter("held_out").collect()
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.7 * len(toxic)


def test_labels_of_held_out_rows_change_nothing(spark, sf_small):
    docs, labels = table(spark, sf_small, "documents"), table(spark, sf_small, "labels")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(toxicity.learn_and_score(docs, x).select("doc_id", "score").collect()) for x in (labels, turned))
    assert a == b


def test_int_map():
    rng = np.random.default_rng(5)
    m, want = bpe.IntMap(2), {}
    for _ in range(30):
        new = np.array([k for k in np.unique(rng.integers(0, 1 << 62 if rng.random() < 0.5 else 200, 40)) if int(k) not in want], np.int64)
        values = rng.integers(0, 1 << 30, len(new))
        m.add(new, values)
        want.update(zip(new.tolist(), values.tolist(), strict=True))
        asked = np.concatenate([np.array([*want], np.int64), rng.integers(0, 400, 50)])
        assert m.get(asked).tolist() == [want.get(k, -1) for k in asked.tolist()]
    assert len(m) == len(want)


def test_matches_together_and_one_by_one(tokenizer, monkeypatch):
    matches = sorted({m.encode() for t in random_texts(300) for m in tokenizer.cut(t)}, key=len)
    matches = [m for m in matches if m not in tokenizer.vocabulary.ranks]
    assert list(tokenizer.encode_together(matches)) == [tokenizer.encode_match(m) for m in matches]
    # Forgetting changes nothing.
    texts = random_texts(200)
    want = list(tokenizer.encode_all(texts))
    monkeypatch.setattr(bpe, "CACHE_MATCHES", 5)
    monkeypatch.setattr(bpe, "KNOWN_PAIRS", 10)
    monkeypatch.setattr(bpe, "TABLE_BYTES", 6)
    monkeypatch.setattr(bpe, "PORTION", 40)
    small = bpe.Tokenizer(registry.RANKS, registry.PATTERN)
    assert list(small.encode_all(texts)) == want


def test_suffix_sums_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 3)
    rows = [(n, 1 + n % 4) for n in (0, 1, 2, 5, 8, 9, 26, 27, 80, 81, 700, 100_000)]
    got = token_counts.suffix_sums(spark.createDataFrame(rows, "n_tokens long, documents long")).collect()
    for r in got:
        later = [(n, d) for n, d in rows if n >= r.n_tokens]
        assert (r.documents_at_least, r.tokens_at_least) == (sum(d for _, d in later), sum(n * d for n, d in later))
        assert r.truncated_total == sum(min(n, r.n_tokens) * d for n, d in rows) and r.total == sum(n * d for n, d in rows)
        assert r.rank_to == sum(d for n, d in rows if n <= r.n_tokens) and r.rank_from == r.rank_to - r.documents + 1
