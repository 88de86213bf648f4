"""One query per training-data operator, `(spark, sf_dir) -> DataFrame`, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import (
    ann, bpe, exact_topk, line_dedup, mixing, periodic_runs, quality, sharding, simhash, spelling, token_counts, toxicity, url_rules,
)
from .common import table

RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

#: One in so many pairs of a document and a word loses a code point.
SPOIL = 199

#: The vocabulary's place on every machine, and the pattern that cuts texts.
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return url_rules.apply_rules(table(spark, sf_dir, "pages"), rules)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = F.crc32(F.coalesce("text", F.lit("")))
    # Computed before the exchange, so that texts aren't moved for it.
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", crc.alias("text_crc32"))
    return sharding.shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text")
    return token_counts.suffix_sums(token_counts.length_histogram(docs, RANKS, PATTERN))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.learn_and_score(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.learn_and_judge(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", *quality.COLUMNS)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(periodic_runs.plant(docs))
    found = found.withColumn("best", periodic_runs.longest(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.vocabulary(docs, spoil=SPOIL))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_line_dedup": op2_line_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_mixing": op4_mixing,
    "op5_sharding": op5_sharding,
    "op6_bpe": op6_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_exact_topk": op8_exact_topk,
    "op9_ann": op9_ann,
    "op10_toxicity": op10_toxicity,
    "op11_quality": op11_quality,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling": op13_spelling,
    "pipeline": pipeline,
}

#: DuckDB statements. The other operators hash with XXH64, train a model, or need the tokenizer; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": """
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
            FROM documents
        ), keyed AS (
            SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), repeated AS (
            SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
        ), judged AS (
            SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.holder AS dropped FROM keyed k LEFT JOIN repeated r ON k.key = r.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op3_url_filter": """
        WITH parts AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), split AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts
        ), rules(verdict, h, p) AS (
            VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                   ('block', 'net', '/es/'), ('block', 'net', '/fr/')
        ), fits AS (
            SELECT s.*, r.h || r.p AS rule, r.verdict
            FROM split s LEFT JOIN rules r ON (s.host = r.h OR ends_with(s.host, '.' || r.h)) AND starts_with(s.path, r.p)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM fits QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
    """,
    "op8_exact_topk": """
        WITH whole AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
        ), scored AS (
            SELECT q.vec_id AS query_id, v.vec_id AS vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
            FROM whole q JOIN whole v ON q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
}
