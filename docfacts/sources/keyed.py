"""A Parquet table with one current row per key.

Each put writes one folder of its own, named by a batch number, and touches nothing
else; the current rows are found when reading. A put that is repeated after a failure
overwrites the same folder, so streams can use it as an exactly-once sink, and its cost
grows with the batch and not with the table. ``compact`` writes the current rows as a
new table when many batches have piled up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfacts.operators.upsert import latest
from docfacts.sources.readers import parquet_or_empty


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str | Sequence[str],
        version: Sequence[str] = (),
    ) -> None:
        """``version`` orders the rows of a key; among equals the later batch wins."""
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.version = key, list(version)

    def put(self, rows: DataFrame, batch: int) -> None:
        """Insert or replace ``rows``. Without ``version`` they must have one row per key."""
        rows = rows.select(*self.schema.fieldNames())
        if self.version:
            rows = latest(rows, self.key, self.version)
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def history(self, before: int | None = None) -> DataFrame:
        """All rows put so far with their ``batch``, or those of batches below ``before``."""
        with_batch = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        rows = parquet_or_empty(self.spark, self.path, with_batch)
        return rows if before is None else rows.filter(F.col("batch") < before)

    def read(self, before: int | None = None) -> DataFrame:
        """The current row of every key."""
        return latest(self.history(before), self.key, [*self.version, "batch"]).drop("batch")

    def compact(self, path: str) -> KeyedTable:
        """The current rows as the first batch of a new table at ``path``."""
        table = KeyedTable(self.spark, path, self.schema, self.key, self.version)
        table.put(self.read(), 0)
        return table
