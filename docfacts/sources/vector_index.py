"""An inverted-file index of vectors: one folder per list, a few lists read for a search.

Fitting takes at most ``sample`` vectors and finds ``lists`` centroids by k-means; every vector
is then written to the list of its nearest centroid. A search reads the lists whose centroids
are nearest to the query, so Spark prunes the other folders, and ranks what it reads by exact
distance. With all lists probed the result is that of an exact search.

The centroids are the only thing the driver holds (``lists`` vectors, a parameter). A list that
holds most vectors is written as many files, as files are balanced by size. A null vector is in
no list; a vector of another length is an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.operators import retrieve

LISTS, SAMPLE, PROBES = 64, 100_000, 8


class VectorIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def build(self, vectors: DataFrame, lists: int = LISTS, sample: int = SAMPLE, key: str = "id", seed: int = 42) -> VectorIndex:
        """Index every row of ``vectors``; ``key`` orders the sample, by its hash."""
        rows = vectors.filter(F.col("embedding").isNotNull()).withColumn(
            "_vector", array_to_vector(F.col("embedding").cast("array<double>"))
        )
        some = rows.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(sample).select("_vector")
        model = KMeans(k=lists, seed=seed, featuresCol="_vector", predictionCol="list", maxIter=10).fit(some)
        model.write().overwrite().save(f"{self.path}/centroids")
        model.transform(rows).drop("_vector").hint("rebalance", "list").write.mode("overwrite").partitionBy("list").parquet(
            f"{self.path}/lists"
        )
        return self

    def nearest_lists(self, query: Sequence[float], probes: int = PROBES) -> list[int]:
        """The lists to read for a query, the nearest centroids first."""
        centers = np.array(KMeansModel.load(f"{self.path}/centroids").clusterCenters())
        far = ((centers - np.asarray(query, dtype=np.float64)) ** 2).sum(axis=1)
        return [int(i) for i in np.argsort(far, kind="stable")[:probes]]

    def candidates(self, query: Sequence[float], probes: int = PROBES) -> DataFrame:
        """The vectors of the lists to read."""
        stored = self.spark.read.parquet(f"{self.path}/lists")
        return stored.filter(F.col("list").isin(self.nearest_lists(query, probes)))

    def search(
        self,
        query: Sequence[float],
        k: int = retrieve.DEFAULT_TOP_K,
        probes: int = PROBES,
        where: dict[str, Any] | None = None,
        tie_break: str = "id",
    ) -> DataFrame:
        """The k nearest vectors of the lists read, with their exact distance."""
        return retrieve.top_k(self.candidates(query, probes), query, k, where, tie_break=tie_break).drop("list")
