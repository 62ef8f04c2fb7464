"""From raw documents to token ids: quality, exact and near copies, benchmark leaks, BPE.

Each stage takes what its predecessor kept; ``run`` writes every stage to the
shared folder and reads it again, so no lineage spans two stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from seriesrel.llm import bagminhash, bpe, exact, quality, spaced_seeds
from seriesrel.llm.queries import BYTE_BPE, quality_weights
from seriesrel.session import scratch_path

ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    weights = quality_weights(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, weights)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.keep_first_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bagminhash.drop_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spaced_seeds.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, token_ids, decoded_sha256`` of the documents that are left."""
    return bpe.encoded_documents(docs, public_tokenizers.path(BYTE_BPE))


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("bpe", encode_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
