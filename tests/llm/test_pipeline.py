"""The pipeline, each stage against brute force on what its predecessor kept."""

from __future__ import annotations

import base64
from collections import Counter

import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from listenlab.llm import mixing, registry, toxicity
from listenlab.llm.common import table
from test_table_operators import brute_targets
from test_text_operators import brute_fingerprint, brute_groups, brute_lines, texts_of


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    """The documents and the rows after each stage, with planted copies and obfuscated insults."""
    docs = table(spark, sf_small, "documents")
    copies = docs.filter("doc_id < 30").withColumn("doc_id", F.col("doc_id") + 5000)
    near = docs.filter("doc_id < 30 and n_chars > 3000").withColumn("doc_id", F.col("doc_id") + 6000).withColumn("text", F.concat("text", F.lit(" end")))
    out = [docs.unionByName(copies).unionByName(near).cache()]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], sf_small).cache())
    return out


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "SimHash near-dedup", "mixing sources", "BPE encoding"]


def test_toxicity_stage(spark, sf_small, stages):
    docs, kept, *_ = stages
    scored = toxicity.learn_and_score(docs, table(spark, sf_small, "labels"))
    clean = Counter(texts_of(scored.filter("score < 0.7")))
    assert Counter(texts_of(kept)) == clean and 0 < sum(clean.values()) <= docs.count()


def test_line_stage(stages):
    _, before, after, *_ = stages
    assert Counter(texts_of(after)) == Counter((i, t) for i, _, _, t in brute_lines(texts_of(before)).elements())
    assert after.filter("n_chars <> length(text)").count() == 0


def test_near_duplicate_stage(stages):
    _, _, before, after, *_ = stages
    rows = texts_of(before)
    groups = brute_groups({brute_fingerprint(t) for _, t in rows})
    first = {}
    for i, t in rows:
        g = groups[brute_fingerprint(t)]
        first[g] = min(first.get(g, i), i)
    assert sorted(i for i, _ in texts_of(after)) == sorted(first.values())
    assert len(rows) > len(first) + 20


def test_mixing_stage(stages):
    _, _, _, before, after, _ = stages
    words = mixing.word_count(F.col("text"))
    size = lambda df: {r.source: r.n for r in df.groupBy("source").agg(F.sum(words).alias("n")).collect()}
    want, got = brute_targets(size(before)), size(after)
    assert all(abs(got.get(s, 0) - t) <= 2 for s, t in want.items())
    whole = dict(texts_of(before))
    seen = Counter(i for i, _ in texts_of(after))
    assert max(seen.values()) <= 2
    # Only the document at a source's cut comes in part, as its first words.
    cut = [(i, t) for i, t in texts_of(after) if t != whole[i]]
    assert len(cut) <= len(want) and all(whole[i].lstrip().startswith(t) for i, t in cut)


def test_encoding_stage(stages):
    before, after = stages[-2:]
    with open(registry.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    known = tiktoken.Encoding("own", pat_str=registry.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter((i, tuple(known.encode_ordinary(t or ""))) for i, t in texts_of(before))
    assert Counter((r.doc_id, tuple(r.token_ids)) for r in after.collect()) == want
    assert after.filter("n_tokens <> size(token_ids)").count() == 0


def test_run(spark, sf_small):
    got = registry.QUERIES["pipeline"](spark, sf_small)
    assert got.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids"]
    assert got.count() > 0


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_edge_and_empty_tables_through_every_stage(spark, sf_small, edge_docs, no_docs, name, stage):
    own = {"score": F.lit(0.5), "predicted": F.lit(9), "size": F.col("doc_id") * 3, "target": F.lit("own"), "taken": F.lit(1.5), "n_lines": F.lit("x"), "source_size": F.lit(True)}
    docs = edge_docs.withColumns(own).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    out = stage(spark, docs, sf_small)
    if name != "BPE encoding":
        assert out.schema.simpleString() == docs.schema.simpleString()
        given = {(r.doc_id, r.score, r.predicted, r["size"], r.target, r.taken, r.n_lines, r.source_size) for r in docs.collect()}
        rows = out.collect()
        assert rows and {(r.doc_id, r.score, r.predicted, r["size"], r.target, r.taken, r.n_lines, r.source_size) for r in rows} <= given
        assert all(r.n_chars == len(r.text or "") for r in rows)
    else:
        assert out.count() == docs.count()
    assert stage(spark, docs.limit(0), sf_small).count() == 0 and stage(spark, no_docs, sf_small).count() == 0
