"""
A training corpus from raw documents: five stages, each on all that its predecessor kept.

Rules drop broken documents, of near-duplicates one stays, repeated sentences are cut out,
the sources are mixed to their target weights (a document can then occur twice), and the mix
is encoded. Every stage's result is written as Parquet in the scratch folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from response_ledger.llm import byte_bpe, fair_mix, host_rules, odd_sketch, sentence_spans
from response_ledger.llm.batches import evaluated, put_back, set_aside
from response_ledger.session import landed


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host is not rejected."""
    judged = host_rules.judge(set_aside(docs, host_rules.ADDED)).where("kept")
    return put_back(judged, docs.columns, host_rules.ADDED)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words a shingle, similarity 0.8 or more."""
    return odd_sketch.without_near_duplicates(docs, words=5, percent=80, lone=False)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents less sentences of repeated runs; those of which nothing is left go."""
    return sentence_spans.cleaned_documents(docs).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, each as often as it is taken."""
    return fair_mix.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and of the decoded texts."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return evaluated(byte_bpe.digests(byte_bpe.round_trip(docs.select("doc_id", "text"), ranks)), "digests")


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

# Shingle graphs, sentence runs and merges are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), "stage")
    return docs
