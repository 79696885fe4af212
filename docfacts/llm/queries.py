"""Registered queries of the operators; each reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docfacts.llm import (
    decontaminate, hash_tree, html_text, language_id, line_dedup, lm_score, mixing, near_dedup, oracles, prefix_trie,
    quality_bands, resampling, secret_ledger, wavelet,
)
from docfacts.llm.common import table
from docfacts.session import scratch_dir


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the items; clean ones have no row."""
    return decontaminate.findings(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """The vocabulary file of the queries; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "tokens")
    wavelet.write(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return wavelet.read(spark, folder)


def op5_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bands.measure(table(spark, sf_dir, "documents"))


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ledger.report(table(spark, sf_dir, "documents"), scratch_dir(spark, "ledger"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op11_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.layout(table(spark, sf_dir, "documents"), oracles.SHARDS)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_lm_score": op3_lm_score,
    "op4_wavelet": op4_wavelet,
    "op5_quality_bands": op5_quality_bands,
    "op6_secret_ledger": op6_secret_ledger,
    "op7_html_text": op7_html_text,
    "op8_mixing": op8_mixing,
    "op9_line_dedup": op9_line_dedup,
    "op10_language_id": op10_language_id,
    "op11_hash_tree": op11_hash_tree,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_resampling": op13_resampling,
}
ORACLES: dict[str, str] = oracles.ORACLES
