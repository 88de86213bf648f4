"""URL rules, mixing, sharding and the vector searches against brute force."""

from __future__ import annotations

import pickle
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from listenlab.llm import ann, exact_topk, mixing, registry, sharding, url_rules
from listenlab.llm.common import table
from oracle_compare import compare, duck

# --- URL rules ---


@pytest.mark.parametrize(
    ("url", "parts"),
    [
        (None, ("", "")),
        ("", ("", "")),
        ("example.com/en", ("", "")),
        ("http://WWW.Example.com", ("www.example.com", "")),
        ("http://a.com/X?y#z", ("a.com", "/X")),
        ("http://a.com?y/z", ("a.com", "")),
        ("x://a.com#b://c", ("a.com", "")),
        ("http:///p", ("", "/p")),
        ("http://É.com:80/ü/", ("É.com:80", "/ü/")),
    ],
)
def test_split_url(url, parts):
    assert url_rules.split_url(url) == parts


def brute_rule(url, rules):
    host, path = url_rules.split_url(url)
    fits = [(len(h) + len(p), len(h), v == "block", f"{h}{p}", v) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


def test_rules_on_random_urls(spark):
    rnd = random.Random(3)
    labels, tops = ["a", "b", "www", "x-y"], ["com", "net", "co.uk"]
    host = lambda n: ".".join([*(rnd.choice(labels) for _ in range(rnd.randint(0, n))), rnd.choice(tops)])
    path = lambda: rnd.choice(["", "/", "/en/", "/en/a", "/en", "/fr/x/y"])
    rules = list({(rnd.choice(["allow", "block"]), host(2), path()) for _ in range(60)})
    urls = [f"http://{host(4)}{path()}{rnd.choice(['', '?q=1', '#t'])}" for _ in range(800)]
    urls += ["http://a.com/en/"] * 400 + [None, "", "nothing", "http://com", "http://.com/", "http://com./"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit("clash")).repartition(7)
    df = spark.createDataFrame([*rules, ("block", None, "/"), ("block", "a.com", None), ("?", "a.com", "/")], "verdict string, host string, path string")
    got = {r.page_id: tuple(r)[1:] for r in url_rules.apply_rules(pages, df).collect()}
    assert got == {i: brute_rule(u, rules) for i, u in enumerate(urls)}
    assert url_rules.apply_rules(pages.limit(0), df).count() == 0
    assert {r.verdict for r in url_rules.apply_rules(pages, df.limit(0)).collect()} == {"allow"}


def test_oracles(spark, sf_mid):
    keys = ["op3_url_filter", "op8_exact_topk"]
    got = compare(spark, sf_mid, keys, con=duck(sf_mid))
    assert [got[k][0] for k in keys] == ["ok", "ok"], got


# --- mixing ---


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    targets, rest, free = {}, share * sum(sizes.values()), set(order)
    while free:
        given = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if given[s] >= most * sizes[s]}
        if not over:
            return targets | given
        targets |= {s: most * sizes[s] for s in over}
        rest -= sum(targets[s] for s in over)
        free -= over
    return targets


def check_mix(rows):
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
        assert r.size == len((r.text or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ")) - (r.text or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ").count("")
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s, t in want.items():
        assert abs(taken[s] - t) <= 2, s


def test_mix(spark, sf_small, edge_docs, no_docs):
    docs = table(spark, sf_small, "documents")
    hot = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("source")))
    for d in (hot, edge_docs):
        rows = mixing.mix(d).collect()
        check_mix(rows)
        again = mixing.mix(d.repartition(5)).collect()
        assert Counter((r.doc_id, r.text, r.taken) for r in rows) == Counter((r.doc_id, r.text, r.taken) for r in again)
    assert mixing.mix(no_docs).count() == 0
    mixed = mixing.mix(hot)
    words = mixing.mixed_documents(mixed).select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert words == mixed.agg(F.sum("taken")).first()[0]


# --- sharding ---


def check_shards(rows, shards, slack):
    total = Counter()
    slots = defaultdict(list)
    for r in rows:
        assert r.size == len((r.text or "").encode()) + 1
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    for s, x in slots.items():
        assert 0 <= s < shards and sorted(x) == list(range(len(x)))
    ideal = sum(total.values()) / shards
    assert all(abs(total[s] - ideal) <= slack for s in range(shards)), total


def test_shards(spark, sf_mid, edge_docs, no_docs):
    docs = table(spark, sf_mid, "documents").select("doc_id", "text")
    rows = sharding.shard(docs).collect()
    check_shards(rows, 8, max(r.size for r in rows))
    where = defaultdict(set)
    for r in rows:
        where[r.text].add(r.shard)
    assert all(len(x) == 1 for x in where.values())
    rows = sharding.shard(edge_docs, shards=3).collect()
    check_shards(rows, 3, max(r.size for r in rows))
    assert len(rows) == 10
    assert sharding.shard(no_docs).count() == 0


def test_a_text_of_most_rows_is_cut(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 < 2, F.lit("the same text " * 5)).otherwise(F.concat(F.lit("own "), "id")).alias("text"))
    rows = sharding.shard(docs, pieces=64).collect()
    check_shards(rows, 8, 0.03 * sum(r.size for r in rows) / 8)


def test_equal_rows_are_cut(spark):
    rows = [(7, "the very same row " * 11)] * 1500 + [(i, f"own {i} " * 30) for i in range(1500)] + [(None, None)] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("more", F.lit(1))
    out = sharding.shard(docs, pieces=64)
    assert out.columns == ["doc_id", "text", "more", "size", "shard", "slot"]
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    check_shards(got, 8, 0.03 * sum(r.size for r in got) / 8)
    assert len({r.shard for r in got if r.doc_id == 7}) >= 4
    # Their keys differ, so that no piece need hold them all.
    numbered = sharding._numbered(docs, sharding.sort_key(F.col("doc_id"), F.col("text")), [docs.filter("doc_id = 7").select(sharding.sort_key(F.col("doc_id"), F.col("text"))).first()[0]])
    key = sharding.sort_key(F.col("doc_id"), F.col("text"), F.col(sharding.COPY))
    assert numbered.filter("doc_id = 7").select(key).distinct().count() > 1400 and numbered.count() == len(rows)


@pytest.mark.parametrize("shares", [[0.04] * 20, [0.03] * 10, [0.12] * 7, [0.11] * 7 + [0.1, 0.025]])
def test_groups_that_fit_a_shard_stay_whole(spark, shares):
    texts = [f"group {i:04d}" for i, x in enumerate(shares) for _ in range(round(6000 * x))]
    texts += [f"own  {i:05d}" for i in range(len(texts), 6000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.shard(docs, pieces=64).collect()
    check_shards(rows, 8, 0.04 * sum(r.size for r in rows) / 8)
    where = defaultdict(set)
    for r in rows:
        where[r.text].add(r.shard)
    assert len(rows) == 6000 and {len(x) for x in where.values()} == {1}


def test_place():
    assert sharding.place({1: 4, 2: 4, 3: 4, 4: 9, 5: 13, 6: 3}, 2, 12) == {4: 0, 1: 1, 2: 1, 3: 1, 6: 0}
    assert sharding.place({}, 3, 0.0) == {}


def test_shard_query_columns(spark, sf_small):
    rows = registry.QUERIES["op5_sharding"](spark, sf_small).collect()
    texts = {r.doc_id: r.text for r in table(spark, sf_small, "documents").collect()}
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) and r.law == "bytes" and r.grown_shard is None for r in rows)


# --- vectors ---


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    out = [(i, rng.normal(size=8).round(3).tolist(), "x") for i in range(700)]
    out += [(i, [0.5] * 8, "x") for i in range(700, 1100)]  # a common vector
    out += [(40, out[40][1], "x"), (2000, None, "x"), (2020, [], "x"), (2040, [1.0] * 7 + [None], "x"), (2060, [float("nan")] * 8, "x"), (2080, [float("inf")] * 8, "x"), (None, [1.0] * 8, "x"), (2100, [0.0] * 8, "x")]
    return out


def clean(rows, zero):
    ok = lambda v: v and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))
    return {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if i is not None and ok(v)}


def test_exact_topk(spark, rows, monkeypatch):
    monkeypatch.setattr(exact_topk, "SHARD_ROWS", 200)
    monkeypatch.setattr(exact_topk, "QUERY_ROWS", 20)
    got = exact_topk.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()
    vecs = {i: np.floor(64 * v).astype(int) for i, v in clean(rows, True).items()}
    want = set()
    for q in (i for i in vecs if i % 20 == 0):
        ranked = sorted((-int(vecs[q] @ v), i) for i, v in vecs.items() if i != q)[:20]
        want |= {(q, n, i, -s) for n, (s, i) in enumerate(ranked, 1)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    few = vectors(spark, rows[:5])
    assert exact_topk.top_k(few, F.col("vec_id") % 20 == 0).count() == 4
    assert exact_topk.top_k(few.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.fixture(scope="module")
def odd_rows():
    """Ids with several vectors, one row twice, and vectors of three lengths."""
    rng = np.random.default_rng(8)
    out = [(i, rng.normal(size=8).round(3).tolist(), "x") for i in range(300)]
    out += [(i, rng.normal(size=4).round(3).tolist(), "x") for i in range(100, 160)]
    out += [(5, [9.0] * 8, "x"), (20, [8.0] * 8, "x"), (20, [8.0] * 8, "y"), (40, [-3.0] * 8, "x"), (60, [1.0], "x"), (61, [2.0], "x")]
    return out


def brute_pairs(rows, change):
    """For each query id its 20 best (score, id) pairs with other ids, over all different vectors of both."""
    kinds = {(i, tuple(change(np.array(v, np.float32).astype(float)).tolist())) for i, v, _ in rows}
    out = {}
    for q, x in sorted(kinds):
        if q % 20 == 0:
            out.setdefault(q, []).extend((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in kinds if i != q and len(x) == len(y))
    return {(q, n, i, -s) for q, pairs in out.items() for n, (s, i) in enumerate(sorted(pairs)[:20], 1)}


def test_every_vector_of_an_id_takes_part(spark, odd_rows, monkeypatch):
    want = brute_pairs(odd_rows, lambda v: np.floor(64 * v))
    got = exact_topk.top_k(vectors(spark, odd_rows), F.col("vec_id") % 20 == 0).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    monkeypatch.setattr(exact_topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(exact_topk, "QUERY_ROWS", 3)
    got = exact_topk.top_k(vectors(spark, odd_rows), F.col("vec_id") % 20 == 0).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    want = {(q, i) for q, _, i, _ in brute_pairs(odd_rows, lambda v: v)}
    got = ann.nearest(vectors(spark, odd_rows), F.col("vec_id") % 20 == 0).collect()
    assert {r.query_id for r in got} == {q for q, _ in want} and len(got) == len(set(got))
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want)
    assert {(r.query_id, r.vec_id) for r in got if r.query_id in (5, 20)} >= {(20, 5)}


def test_far_shards_are_not_searched(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "SHARD_ROWS", 50)
    monkeypatch.setattr(exact_topk, "QUERY_ROWS", 20)
    rng = np.random.default_rng(9)
    centres = np.eye(8) * 10
    rows = [(i, (centres[i % 8] + rng.normal(size=8) * 0.2).round(3).tolist(), "x") for i in range(1600)]
    is_query = F.col("vec_id") % 4 == 0
    index = exact_topk.build(vectors(spark, rows), is_query)
    shards, blocks = index.shards.collect(), index.blocks.count()
    assert sum(len(pickle.loads(s.tree)[1]) for s in shards) == 1600
    assert max(len(pickle.loads(s.tree)[1]) for s in shards) <= 100
    searched = exact_topk.pairs_to_search(index, exact_topk.first_search(index)).count()
    assert searched < 0.2 * len(shards) * blocks
    got = exact_topk.top_k(vectors(spark, rows), is_query).collect()
    v = np.floor(64 * np.array([r[1] for r in rows], np.float32).astype(float)).astype(int)
    for q in range(0, 1600, 80):
        ranked = sorted((-int(v[q] @ v[i]), i) for i in range(1600) if i != q)[:20]
        assert sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q) == [(n, i, -s) for n, (s, i) in enumerate(ranked, 1)]


def test_cells():
    rng = np.random.default_rng(10)
    sample = np.concatenate([rng.normal(size=(500, 3)), np.ones((400, 3))])
    cells = exact_topk.fit_cells(sample, 8)
    assert len({*cells.of(sample)}) == 8 == sum(k is None for k in cells.children)
    assert len({*cells.of(np.ones((5, 3)))}) == 1
    same = exact_topk.fit_cells(np.ones((100, 3)), 4)
    assert same.children == [None]


def test_huge_components_stay_exact():
    tree = exact_topk.BallTree(np.array([[2.0**30, 1.0], [2.0**30, 2.0], [-(2.0**30), 3.0]]))
    scores, ids = exact_topk.search(tree, np.array([1, 2, 3]), np.array([[2.0**30, 1.0]]), np.array([9]), np.array([-np.inf]), 2)
    assert scores.tolist() == [[2**60 + 2, 2**60 + 1]] and ids.tolist() == [[2, 1]]


def test_ann(spark, rows):
    got = ann.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()
    vecs = clean(rows, False)
    queries = [i for i in vecs if i % 20 == 0]
    found = defaultdict(list)
    for r in got:
        assert r.score == sum(a * b for a, b in zip(vecs[r.query_id], vecs[r.vec_id], strict=True)) and r.query_id != r.vec_id
        found[r.query_id].append((r.rank, -r.score, r.vec_id))
    near = 0
    for q in queries:
        ranked = sorted(found[q])
        assert [x[0] for x in ranked] == list(range(1, 21)) and [x[1:] for x in ranked] == sorted(x[1:] for x in ranked)
        kth = sorted((float(vecs[q] @ v) for i, v in vecs.items() if i != q), reverse=True)[19]
        near += sum(-x[1] >= kth - 1e-9 for x in ranked)
    assert near >= 0.9 * 20 * len(queries)
    few = vectors(spark, rows[:5])
    assert ann.nearest(few, F.col("vec_id") % 20 == 0).count() == 4
    assert ann.nearest(few.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_ann_groups_are_bounded(spark, rows, monkeypatch):
    is_query = F.col("vec_id") % 2 == 0
    [index] = ann.build(vectors(spark, rows))
    want = {tuple(r) for r in ann.search(index, is_query, 2).collect()}
    monkeypatch.setattr(ann, "PART_ROWS", 100)
    monkeypatch.setattr(ann, "QUERY_ROWS", 50)
    groups, met = defaultdict(lambda: ([], [])), Counter()
    for r in ann._groups(index, is_query, 2, ann.K).collect():
        groups[r.leaf, r.part, r.block][r.is_query].append(r.vec_id)
    for held, queries in groups.values():
        assert len(held) <= 150 and len(queries) <= 80
        met.update((q, v) for q in queries for v in held)
    assert set(met.values()) == {1}
    leaf = {r.vec_id: r.leaf for r in index.rows.collect()}
    size = Counter(leaf.values())
    visited = Counter(q for q, _ in met)
    assert max(size.values()) > 300 and set(visited) == {i for i in leaf if i % 2 == 0}
    assert all(n == sum(size[x] for x in {leaf[v] for p, v in met if p == q}) for q, n in [*visited.items()][:20])
    assert {tuple(r) for r in ann.search(index, is_query, 2).collect()} == want


def test_ann_recall_on_the_table(spark, sf_mid):
    got = {(r.query_id, r.vec_id) for r in registry.QUERIES["op9_ann"](spark, sf_mid).collect()}
    data = table(spark, sf_mid, "embeddings").collect()
    x, ids = np.array([r.embedding for r in data], float), np.array([r.vec_id for r in data])
    true = set()
    for q in np.flatnonzero(ids % 20 == 0):
        order = [i for i in np.lexsort((ids, -(x @ x[q]))) if i != q][:20]
        true |= {(int(ids[q]), int(ids[i])) for i in order}
    assert len(got) == len(true) and len(got & true) >= 0.9 * len(true)
