"""The registered queries of the training-data operators, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from response_ledger.llm import (
    byte_bpe, fair_mix, host_rules, mixing_coder, odd_sketch, oracles, pair_bitmaps, prefix_forest,
    resync_counts, robust_graph, sentence_spans, spectrum_whitening, subword_quality, toxicity_cnn,
)
from response_ledger.llm.batches import evaluated


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return resync_counts.count_tokens(documents, public_tokenizers.path("byte_bpe_50k.json"))


def op2_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return toxicity_cnn.classify(documents, labels)


def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "n_sentences", "n_removed", "n_in_spans"
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return evaluated(byte_bpe.digests(byte_bpe.round_trip(documents, ranks)), "digests")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    segments = mixing_coder.write_tokens(documents, public_tokenizers.path("byte_bpe_50k.json"))
    return mixing_coder.read_tokens(segments, with_ids=False)


def op7_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return fair_mix.mix(documents, keep_text=False).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return subword_quality.classify(documents, labels)


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return host_rules.judge(documents, keep_text=False).select(
        "doc_id", *host_rules.MEASURES, "base_failed", "kept"
    )


def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return pair_bitmaps.align(documents, *paths)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectrum_whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_prefix_forest": op2_prefix_forest,
    "op3_toxicity": op3_toxicity,
    "op4_sentence_spans": op4_sentence_spans,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_token_files": op6_token_files,
    "op7_fair_mix": op7_fair_mix,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_host_rules": op9_host_rules,
    "op10_quality": op10_quality,
    "op11_near_vectors": op11_near_vectors,
    "op12_alignment": op12_alignment,
    "op13_whitening": op13_whitening,
}

ORACLES = oracles.ORACLES
