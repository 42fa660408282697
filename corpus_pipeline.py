"""Corpus preparation in five stages: STAGES, run and ORACLE_SQL.

Every stage takes (spark, docs, sf_dir), docs being all rows that its predecessor
kept, and returns rows of the columns of ``docs``; the last returns the token shards'
digest.  ``run`` writes every result to the shared folder and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emporia.llm import bytecnn, jaccard, latent, mixing, tokens
from emporia.llm.queries import table, tokenizer_json
from emporia.llm.scratch import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; it learns as op5 does."""
    model = bytecnn.train(docs, table(spark, sf_dir, "labels"))
    return bytecnn.keep_quality(docs, model, 0.3)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group linked by five-word shingles with
    a similarity of 0.8 or more.  Rows equal in all columns count as one; a row
    with a null doc_id is in no group and stays."""
    groups = jaccard.jaccard_components(docs, shingle=5, percent=80)
    later = groups.where("doc_id <> component_id").select("doc_id").distinct()
    # Texts are shuffled once, by doc_id, for the join and for equal rows; the ids grow
    # with the corpus, so they are not broadcast.
    return docs.join(later.hint("merge"), "doc_id", "left_anti").select(*docs.columns).distinct()


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy or paraphrase of a benchmark item."""
    return latent.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it."""
    return mixing.emit_mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in shards, and what they hold per document."""
    return tokens.token_digest(tokens.write_shards(docs.select("doc_id", "text"), tokenizer_json()))


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_group),
    ("decontamination", drop_benchmark),
    ("mixing", mix),
    ("token_shards", write_tokens),
]

# The fitted and iterative stages have no SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
