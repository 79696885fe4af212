"""The corpus pipeline: from documents to token files in five stages.

Each stage is an operator of ``docfacts.llm`` with the parameters of its own query. It
works on all rows its predecessor kept, and ``run`` writes and rereads them in between, so
that a lost executor costs one stage at most. The mixing stage returns a row for each pass
over a document, with the words taken in that pass; the last one returns a row for each
row it encoded, read back from the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docfacts.llm import decontaminate, language_id, mixing, near_dedup, wavelet
from docfacts.llm.common import table
from docfacts.llm.queries import tokenizer_path
from docfacts.session import scratch_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified with a sufficient score."""
    return language_id.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.kept(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources, a row for each pass over a document."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of wavelet matrices, and what they hold of each row."""
    folder = scratch_dir(spark, "tokens")
    wavelet.write(docs, folder, tokenizer_path())
    return wavelet.read(spark, folder)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token_files", tokens),
]

#: SQL can't express the signatures, the alignment or the tokenizer; the tests compare
#: each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
