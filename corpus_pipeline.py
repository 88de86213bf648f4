"""From raw documents to tokens of a training mix, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that its predecessor kept. Its result is
written as Parquet in the shared folder and read again as the next one's docs, so a lost executor costs one stage at most.
All but the last return the columns of documents, with their own values also where an operator names a column of its result alike; n_chars follows
the text. Missing columns stay missing. The last one's token_ids and n_tokens replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlab.llm import bpe, line_dedup, mixing, simhash, toxicity
from listenlab.llm.common import stash, table

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def _with_sizes(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))
    return docs.select(*columns)


def _keeping(docs: DataFrame, results: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`stage` of `docs`, whose columns named as its `results` are put aside meanwhile."""
    aside = {c: f"__own_{c}" for c in docs.columns if c in results}
    out = stage(docs.withColumnsRenamed(aside)).drop(*aside).withColumnsRenamed({v: k for k, v in aside.items()})
    return out.select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't predict to be toxic."""
    labels = table(spark, sf_dir, "labels")
    return _keeping(docs, ("score", "predicted"), lambda d: toxicity.learn_and_score(d, labels).filter(F.col("predicted") == 0))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share."""
    return _with_sizes(_keeping(docs, ("n_lines", "n_dropped"), line_dedup.dedup_lines), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time that a document is taken, as far as it is taken."""
    mixed = _keeping(docs, ("size", "source_size", "target", "taken"), lambda d: mixing.mixed_documents(mixing.mix(d)))
    return _with_sizes(mixed, docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every row of the mix, with its document's id, language and source."""
    encoded = bpe.encode(docs, RANKS, PATTERN)
    return encoded.select(*(c for c in docs.columns if c not in ("text", "n_chars")), "n_tokens", "token_ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("BPE encoding", encode),
]

#: The stages train a model, hash with XXH64 and need a tokenizer, which SQL can't express; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
