"""Intake, attempt counting and upserts on streams.

What a stream has to remember is kept by key in Spark's state store (RocksDB, snapshots below the
checkpoint): the hashes let in so far, and the attempts of each report. A micro-batch touches
the keys it holds and nothing else, however old the stream is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docfacts.operators import intake
from docfacts.sources.keyed import KeyedTable
from docfacts.sources.prefixed import PrefixedTable

# Copies of one text are first dropped within this many shares, then across them.
DEDUP_SHARES = 16

Batch = Callable[[DataFrame, int], None]


def intake_stream(
    uploads: DataFrame, watermark: tuple[str, str] | None = None, shares: int = DEDUP_SHARES
) -> DataFrame:
    """Accepted uploads of a stream with their ``content_hash``.

    A text that arrives very often is dealt out over ``shares`` tasks by the first of
    two stateful steps; only one copy of each share reaches the second. Which copy
    survives is open, as it is for uploads that arrive together.

    Hashes are kept for ever, as exact deduplication needs. ``watermark`` (event-time
    column, delay) bounds that state: copies further apart than the delay then pass.
    """
    rows = intake.checked(uploads).filter(F.col("error").isNull()).drop("error")
    rows = rows.withColumn("_share", F.floor(F.rand() * shares).cast("int"))
    if watermark is None:
        kept = rows.dropDuplicates(["content_hash", "_share"]).dropDuplicates(["content_hash"])
    else:
        kept = (
            rows.withWatermark(*watermark)
            .dropDuplicatesWithinWatermark(["content_hash", "_share"])
            .dropDuplicatesWithinWatermark(["content_hash"])
        )
    return kept.drop("_share", "_corrupt_record")


def attempts(stream: DataFrame, key: str = "report_id") -> DataFrame:
    """Attempts per report so far, for the update output mode.

    Counts are added up in the map tasks before the shuffle.
    """
    return stream.groupBy(key).agg(F.count("*").alias("attempts"))


def each_batch(
    stream: DataFrame, run: Batch, checkpoint: str, mode: str = "append", **trigger
) -> StreamingQuery:
    """Start ``run`` on every micro-batch; by default until the present input is used up."""
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def land(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a stream to the Parquet files below ``path``, each row once; by default until the
    present input is used up."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def put_batch(table: KeyedTable | PrefixedTable) -> Batch:
    """Keep ``table`` at the latest row of each key of a stream."""
    return table.put
