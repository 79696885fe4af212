"""Embeddings and exact nearest-passage retrieval.

Spark plan: the query vector is one row and is written into the expression, so
distances are computed in the scan stage without any join; vectors of the default encoder
go to their distance within one Python worker. A global top-k is a
``TakeOrderedAndProject``. A scoped top-k keeps k rows per scope in every map task
before its shuffle (Spark's window group limit), so a report that owns a third of all
passages sends k rows per task. Spark has that limit for small k only; for others a scope is
dealt out first, k rows are kept of each share, and only these are merged.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfacts.functions import text
from docfacts.functions.vectors import WORD, distance, lists_with_dimension, squared_l2_by_batches, unit_vectors
from docfacts.session import computed_once

# What extraction searches for, and how many passages it needs.
RETRIEVAL_QUERY = "mineral occurrence depth coordinates assay grade drill hole"
RETRIEVAL_TOP_K = 4
DEFAULT_TOP_K = 5


class TermEncoder:
    """Default encoder: signed feature hashing, weighted by rarity, at unit length.

    A word's MD5 draws its dimension and sign. A dimension weighs by how few passages have a
    word in it, as a whole number (thousandths of a logarithm). Fitting reads the corpus once and
    keeps one weight per dimension; encoding goes by Arrow batches, without any shuffle.
    Components are multiples of 2 ** -14, so that distances are exact sums.
    """

    def __init__(self, dims: int = 256) -> None:
        self.dims = dims
        self.weights: list[int] | None = None

    def _words(self, text_col: str) -> Column:
        return F.regexp_extract_all(F.lower(F.coalesce(text_col, F.lit(""))), F.lit(WORD), F.lit(0))

    def fit(self, corpus: DataFrame, text_col: str = "text") -> TermEncoder:
        """Each task counts its passages; at most one count for each dimension, and one for all,
        reach the driver."""
        dims = self.dims

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            passages, everything = np.zeros(dims, np.int64), 0
            for batch in batches:
                passages += lists_with_dimension(batch.column(0), dims)
                everything += batch.num_rows
            counts = np.append(passages, everything)
            yield pa.RecordBatch.from_arrays([pa.array(range(dims + 1), pa.int32()), pa.array(counts)], ["dim", "n"])

        counted = corpus.select(self._words(text_col).alias("words")).mapInArrow(count, "dim int, n long")
        found = {row["dim"]: row["n"] for row in counted.groupBy("dim").agg(F.sum("n").alias("n")).collect()}
        everything = found.get(dims, 0)
        self.weights = [math.floor(1000 * math.log((everything + 1) / (found.get(d, 0) + 1)) + 0.5) for d in range(dims)]
        return self

    def encode(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        if self.weights is None:
            self.fit(df, text_col)
        weights = np.array(self.weights, np.int64)

        @F.arrow_udf("array<double>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for words in batches:
                yield unit_vectors(words, weights)

        kept = [c for c in df.columns if c != "embedding"]
        return df.select(*kept, run(self._words(text_col)).alias("embedding"))


class BatchEncoder:
    """Any Python encoder: ``load()`` runs once per task and returns ``texts -> vectors``."""

    def __init__(self, load: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]]):
        self.load = load

    def encode(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        load = self.load

        @F.pandas_udf("array<double>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encode = load()
            for texts in batches:
                vectors = encode(texts.tolist())
                yield pd.Series([np.asarray(v, np.float64) for v in vectors], dtype=object)

        return df.withColumn("embedding", run(F.col(text_col)))


def embed(df: DataFrame, encoder: Any = None, text_col: str = "text") -> DataFrame:
    """Add ``embedding`` with the given encoder, by default a ``TermEncoder`` fitted on ``df``."""
    return (encoder or TermEncoder()).encode(df, text_col)


def encode_query(df: DataFrame, encoder: Any, query: str = RETRIEVAL_QUERY) -> list[float]:
    """The vector of one query text. A single row reaches the driver."""
    one = df.sparkSession.range(1).select(F.lit(query).alias("text"))
    return list(encoder.encode(one, "text").first()["embedding"])


def _ranked(
    vectors: DataFrame, query: Sequence[float] | Column, where: dict[str, Any] | None, metric: str
) -> DataFrame:
    for name, wanted in (where or {}).items():
        vectors = vectors.filter(F.col(name) == F.lit(wanted))
    if metric == "l2" and not isinstance(query, Column):
        found = vectors.withColumn("distance", squared_l2_by_batches(F.col("embedding"), query))
    else:
        found = computed_once(vectors, {"distance": distance(F.col("embedding"), query, metric)})
    return found.filter(F.col("distance").isNotNull()).drop("embedding")


# Shares that a scope is dealt out to where k is too large for Spark's own limit.
SHARES = 32


def _nearest_per_scope(hits: DataFrame, k: int, scope: str, tie_break: str) -> DataFrame:
    """``rank`` within each scope, up to k. No task sorts more of a scope than a share of it, or
    k rows of each share."""
    limit = int(hits.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    nearest = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("distance", tie_break))
    if k >= limit:
        share = F.pmod(F.xxhash64(tie_break, "distance"), F.lit(SHARES))
        hits = hits.withColumn("_share", share).withColumn("rank", nearest(scope, "_share"))
        hits = hits.filter(F.col("rank") <= k).drop("_share", "rank")
    return hits.withColumn("rank", nearest(scope)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    query: Sequence[float] | Column,
    k: int = DEFAULT_TOP_K,
    where: dict[str, Any] | None = None,
    scope: str | None = None,
    metric: str = "l2",
    tie_break: str = "id",
) -> DataFrame:
    """The k nearest vectors, overall or within each value of ``scope``.

    ``where`` restricts the candidates before ranking. Adds ``distance`` and, when
    scoped, ``rank``.
    """
    hits = _ranked(vectors, query, where, metric)
    if scope is None:
        return hits.orderBy("distance", tie_break).limit(k)
    return _nearest_per_scope(hits, k, scope, tie_break)


def context(reports: DataFrame, hits: DataFrame) -> DataFrame:
    """Add ``context``: the retrieved passages of each report in text order.

    A report without hits keeps its full text. Only positions are gathered and joined, at
    most k numbers a report; the passages are then picked from the report's own text, so
    no passage moves. A position that the report does not have is dropped.
    """
    places = hits.groupBy("report_id").agg(F.array_sort(F.collect_list("chunk_index")).alias("_places"))
    found = computed_once(
        reports.join(places, "report_id", "left"),
        {"_pieces": F.when(F.col("_places").isNotNull(), text.passages(F.col("text")))},
    )
    picked = F.transform("_places", lambda i: text.strip(F.get("_pieces", i)))
    joined = F.array_join(F.filter(picked, lambda passage: passage != ""), " ")
    return found.withColumn(
        "context", F.coalesce(F.nullif(joined, F.lit("")), F.col("text"))
    ).drop("_places", "_pieces")


def retrieve(
    reports: DataFrame,
    encoder: Any,
    query: Sequence[float],
    index: DataFrame | None = None,
    k: int = RETRIEVAL_TOP_K,
) -> DataFrame:
    """Reports with their retrieval context; ``index`` holds already embedded chunks."""
    from docfacts.operators.chunk import chunk

    vectors = embed(chunk(reports), encoder) if index is None else index
    hits = top_k(
        vectors.select("report_id", "chunk_index", "embedding"),
        query,
        k,
        scope="report_id",
        tie_break="chunk_index",
    )
    return context(reports, hits)
