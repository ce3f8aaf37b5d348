"""Queries of this subpackage: one ``op<N>_<name>`` per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blotter.llm import collocations, html_blocks, latent_leaks, license_align, near_dups, pii_lstm, quality_gbt, secrets_markov, spm_viterbi, suffix_dedup, token_align, token_counts, url_rules


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return quality_gbt.quality_scores(docs, quality_gbt.fit(docs, _read(spark, sf_dir, "labels")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, sf_dir, "documents"))


def op3_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.components(_read(spark, sf_dir, "documents"))


def op4_spm_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm_viterbi.encode(_read(spark, sf_dir, "documents"))


def op5_pii_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return pii_lstm.personal_spans(docs, pii_lstm.fit(docs))


def op6_license_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_align.licenses(_read(spark, sf_dir, "documents"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.url_verdicts(_read(spark, sf_dir, "pages"))


def op8_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(_read(spark, sf_dir, "pages"))


def op9_secrets_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return secrets_markov.secret_spans(docs, secrets_markov.fit(docs))


def op10_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent_leaks.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.alignments(_read(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_gbt": op1_quality_gbt,
    "op2_token_counts": op2_token_counts,
    "op3_near_dups": op3_near_dups,
    "op4_spm_viterbi": op4_spm_viterbi,
    "op5_pii_lstm": op5_pii_lstm,
    "op6_license_align": op6_license_align,
    "op7_url_rules": op7_url_rules,
    "op8_html_blocks": op8_html_blocks,
    "op9_secrets_markov": op9_secrets_markov,
    "op10_latent_leaks": op10_latent_leaks,
    "op11_token_align": op11_token_align,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_collocations": op13_collocations,
}

SQL: dict[str, str] = {"op7_url_rules": url_rules.verdict_sql(), "op13_collocations": collocations.collocation_sql()}
