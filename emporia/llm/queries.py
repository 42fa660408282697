"""The operators of this subpackage as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import bpe, bytecnn, jaccard, latent, licences, lines, lm, mixing, pivots, repair, runs, substrings, tokens
from emporia.llm.sql import JACCARD_SQL, LICENCE_SQL, LINES_SQL, MIX_SQL, SUBSTRING_SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file as text; by default the installed byte-level BPE."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return Path(path).read_text(encoding="utf-8")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, percent=85)


def op2_gru_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and recurrent-model log probabilities of whole texts."""
    return lm.score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_latent_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a copy or paraphrase of a benchmark item, with the item."""
    return latent.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their source's target and the words that the mix takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sources(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op5_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of whole texts by a byte-level network fitted on the other folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = bytecnn.train(docs, table(spark, sf_dir, "labels"))
    scored = bytecnn.score_quality(docs, model)
    return scored.select("doc_id", (bytecnn.fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as token ids and read back from the shards."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.token_digest(tokens.write_shards(docs, tokenizer_json()))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that stay when later copies of line runs go."""
    kept = lines.drop_line_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", "longest_shared", F.sha2("kept", 256).alias("kept_sha256"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stay when later copies of 13-word windows go."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = substrings.drop_repeats(docs, 13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_pivot_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of vectors with a cosine of 0.9 or more."""
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 0.9)


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document, lists as text."""
    found = licences.scan_licences(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.concat_ws("|", "sentence_ids").alias("sentence_ids"), F.concat_ws("|", "licences").alias("licences"), "n_rules")


def op11_glr_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of damaged conversations and their cheapest repair to the role grammar."""
    return repair.repair_digest(table(spark, sf_dir, "conversations"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of which get one planted."""
    return runs.run_digest(runs.plant_runs(table(spark, sf_dir, "documents")))


def op13_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of what they decode to."""
    return bpe.round_trip_digest(table(spark, sf_dir, "documents"), tokenizer_json())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_gru_score": op2_gru_score,
    "op3_latent_decontaminate": op3_latent_decontaminate,
    "op4_mix_sources": op4_mix_sources,
    "op5_byte_cnn": op5_byte_cnn,
    "op6_token_shards": op6_token_shards,
    "op7_line_dedup": op7_line_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_pivot_neardup": op9_pivot_neardup,
    "op10_licence_scan": op10_licence_scan,
    "op11_glr_repair": op11_glr_repair,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_rank_array_bpe": op13_rank_array_bpe,
}

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard": JACCARD_SQL,
    "op4_mix_sources": MIX_SQL,
    "op7_line_dedup": LINES_SQL,
    "op8_substring_dedup": SUBSTRING_SQL,
    "op10_licence_scan": LICENCE_SQL,
}
