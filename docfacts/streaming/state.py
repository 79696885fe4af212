"""Streams with memory: intake verdicts and attempt admission on keyed state.

Both are ``transformWithState`` operators. Intake keeps one mark for each content hash, admission
one counter for each report; a micro-batch reads and writes the keys it holds, so its cost
doesn't grow with the age of the stream. Texts never reach the Python workers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from docfacts.operators import extract, intake

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Rows that need no look-up are dealt out over this many groups, whose names no hash can have.
SPREAD = 64
_SPREAD_MARK = "~"


def _on_rocksdb(spark: SparkSession) -> None:
    """Keyed state needs this store; it must be set before a query starts."""
    spark.conf.set(STORE, ROCKSDB)


def _order(values: Sequence[Any]) -> tuple:
    """A sort key in which null comes last."""
    return tuple((v is None, v) if v is not None else (True,) for v in values)


def _candidates(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``_candidate``: whether a row may be the first of its text.

    Of the copies in one Arrow batch only the earliest may, so a text that makes up most of a
    micro-batch sends a row for each batch of ten thousand to the group of its hash.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("_candidate", T.BooleanType())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("content_hash").to_pylist()
            earliest: dict[str, tuple] = {}
            for at, (content, *arrival) in enumerate(zip(hashes, *(batch.column(c).to_pylist() for c in order))):
                if content is not None:
                    mine = (_order(arrival), at)
                    if content not in earliest or mine < earliest[content]:
                        earliest[content] = mine
            first = {at for _, at in earliest.values()}
            flags = pa.array([at in first for at in range(batch.num_rows)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, flags], [*batch.schema.names, "_candidate"])

    return rows.mapInArrow(mark, schema)


class _FirstWins(StatefulProcessor):
    """Lets the earliest candidate of a hash in, once and for all."""

    def __init__(self, order: Sequence[str], columns: Sequence[str]):
        self.order, self.columns = list(order), list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "seen boolean")

    def _row(self, row: Row, status: str) -> Row:
        return Row(**{c: row[c] for c in self.columns}, status=status)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        if key[0].startswith(_SPREAD_MARK):
            for row in rows:
                yield self._row(row, intake.DUPLICATE if row["error"] is None else intake.REJECTED)
            return
        known, first = self.known.exists(), None
        for row in rows:
            if known:
                yield self._row(row, intake.DUPLICATE)
            elif first is None:
                first = row
            else:
                earlier = _order([row[c] for c in self.order]) < _order([first[c] for c in self.order])
                late, first = (first, row) if earlier else (row, first)
                yield self._row(late, intake.DUPLICATE)
        if first is not None:
            self.known.update((True,))
            yield self._row(first, intake.ACCEPTED)

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        self.known.update((True,))

    def close(self) -> None:
        pass


def verdicts(
    uploads: DataFrame, order_by: str | Sequence[str], registry: DataFrame | None = None
) -> DataFrame:
    """Intake of a stream with all three outcomes: accepted, duplicate and rejected.

    A stream of ``report_id``, the columns of ``order_by``, ``content_hash``, ``error`` and
    ``status``; texts stay behind and can be joined by hash and id. Of the copies of a text in
    one micro-batch the earliest by ``order_by`` (null last) is let in, and none after it.
    A hash is remembered for ever; ``registry`` has those of earlier runs, which are taken into
    the state when the stream starts for the first time.
    """
    _on_rocksdb(uploads.sparkSession)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    columns = list(dict.fromkeys(["report_id", *order, "content_hash", "error"]))
    rows = _candidates(intake.checked(uploads).select(*columns), order)
    spread = F.concat(F.lit(_SPREAD_MARK), F.pmod(F.xxhash64(*columns), F.lit(SPREAD)).cast("string"))
    keyed = rows.withColumn("_group", F.when(F.col("_candidate"), F.col("content_hash")).otherwise(spread))
    schema = T.StructType([*[rows.schema[c] for c in columns], T.StructField("status", T.StringType())])
    known = None
    if registry is not None:
        known = registry.select(F.col("content_hash").alias("_group")).distinct().groupBy("_group")
    return keyed.groupBy("_group").transformWithState(_FirstWins(order, columns), schema, "Append", "None", known)


class _Counter(StatefulProcessor):
    """Numbers the attempts of a report from where its counter stands."""

    def __init__(self, order: Sequence[str], max_attempts: int, idle: tuple[str, int] | None):
        self.order, self.max_attempts, self.idle = list(order), max_attempts, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.used = handle.getValueState("used", "attempts long")

    def _place(self, row: Row) -> tuple:
        """A sort key in which null, and NaN, comes first."""
        return tuple((False,) if v is None or v != v else (True, v) for v in (row[c] for c in self.order))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        batch = sorted(rows, key=self._place)
        state = self.used.get()
        used = int(state[0]) if state is not None else 0
        self.used.update((used + len(batch),))
        if self.idle is not None:
            times = [t for t in (row[self.idle[0]] for row in batch) if t is not None]
            if times:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                last = pd.Timestamp(max(times))
                last = last.tz_localize("UTC") if last.tz is None else last
                self.handle.registerTimer(int(last.timestamp() * 1000) + 1000 * self.idle[1])
        for number, row in enumerate(batch, used + 1):
            yield Row(**row.asDict(), attempts=number, allowed=number <= self.max_attempts)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.used.clear()
        return iter(())

    def close(self) -> None:
        pass


def admissions(
    attempts: DataFrame,
    order_by: str | Sequence[str],
    max_attempts: int = extract.MAX_ATTEMPTS,
    key: str = "report_id",
    idle: tuple[str, str, int] | None = None,
) -> DataFrame:
    """A verdict for every attempt of a stream: adds ``attempts`` (the counter after it) and ``allowed``.

    Attempts of a micro-batch are numbered in the order of ``order_by``, null first, after
    those of earlier batches. Carry only the columns that are needed: the attempts of one
    report in one micro-batch are numbered together, and the source's limit on a batch
    (``maxFilesPerTrigger``, ``maxBytesPerTrigger``) bounds them.

    Counters are kept for ever, as an exact count needs. ``idle`` (time column, watermark
    delay, seconds) lets a report go that had no attempt for so long: a timer clears its
    counter when the watermark has passed, and a later attempt counts from one again.
    """
    _on_rocksdb(attempts.sparkSession)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rows, mode, limit = attempts, "None", None
    if idle is not None:
        column, delay, seconds = idle
        rows, mode, limit = attempts.withWatermark(column, delay), "EventTime", (column, seconds)
    schema = T.StructType([
        *attempts.schema.fields, T.StructField("attempts", T.LongType()), T.StructField("allowed", T.BooleanType())
    ])
    return rows.groupBy(key).transformWithState(_Counter(order, max_attempts, limit), schema, "Append", mode)
