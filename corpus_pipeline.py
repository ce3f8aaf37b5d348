"""Corpus pipeline: quality rules, near-dedup, decontamination, secret scans, SentencePiece ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the first three
filter rows, the fourth rewrites texts, the last adds each text's ids. Rows without
text fail the quality rules; empty documents pass through all stages as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blotter.llm import latent_leaks, near_dups, quality_gbt, secrets_markov, spm_viterbi
from blotter.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the trees reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_gbt.keep_good(docs, quality_gbt.fit(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that is alike by 0.8 on five-word shingles."""
    return near_dups.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return latent_leaks.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secrets_markov.redact(docs, secrets_markov.fit(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their texts' ids."""
    return spm_viterbi.attach_ids(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secret_scans", secret_scans),
    ("token_ids", token_ids),
]

#: Trees, minwise paths, Markov models and merges are beyond SQL: tests/llm/test_pipeline.py holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
