"""Keyed insert-or-replace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, key: str | Sequence[str], version: str | Sequence[str]) -> DataFrame:
    """The row with the highest version of each key.

    Spark limits the ranking to one row per key in every map task, so a key written
    very often is not shuffled in full.
    """
    keys = [key] if isinstance(key, str) else list(key)
    versions = [version] if isinstance(version, str) else list(version)
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(v) for v in versions])
    return (
        rows.withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def upsert(
    stored: DataFrame | None,
    written: DataFrame,
    key: str | Sequence[str],
    version: str | Sequence[str],
) -> DataFrame:
    """``stored`` after ``written`` was put into it: the last version of a key wins."""
    rows = written if stored is None else stored.unionByName(written)
    return latest(rows, key, version)
