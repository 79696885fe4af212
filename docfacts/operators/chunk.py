"""Sentence passages of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfacts.functions import text


def chunk(df: DataFrame, id_col: str = "report_id", text_col: str = "text") -> DataFrame:
    """One row per passage: id, report_id, chunk_index, text. No shuffle."""
    exploded = df.select(
        F.col(id_col).cast("string").alias("report_id"),
        F.posexplode(text.passages(F.col(text_col))).alias("chunk_index", "_passage"),
    )
    return exploded.select(
        F.concat("report_id", F.lit("-chunk-"), F.col("chunk_index").cast("string")).alias("id"),
        "report_id",
        "chunk_index",
        text.strip(F.col("_passage")).alias("text"),
    ).filter(F.col("text") != "")


def with_metadata(chunks: DataFrame) -> DataFrame:
    """The nested form used at rest: report and position inside ``metadata``."""
    rest = [c for c in chunks.columns if c not in ("report_id", "chunk_index")]
    return chunks.select(*rest, F.struct("report_id", "chunk_index").alias("metadata"))
