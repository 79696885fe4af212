"""Extraction with a validation gate: failed rows, and only those, get another attempt.

A provider turns prompts into output texts. Two kinds exist:

* ``ColumnProvider`` answers with a Spark expression. All rounds then form one
  projection over one scan: a later round is guarded by ``CASE WHEN``, so rows that
  passed are not evaluated again, and nothing is shuffled or written in between.
* ``BatchProvider`` answers with Python (one client per task, whole batches). Its
  answers cannot be repeated, so every round is written to the shared folder before it
  is split: a lost executor or a second action never asks the provider again. A
  ``LedgerProvider`` around it keeps the answers over runs as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docfacts.functions import text
from docfacts.operators.parse import parse_outputs
from docfacts.operators.validate import DOMAIN_RULES, Rule, check, reason
from docfacts.schemas import ANSWER, RECORD_FIELDS
from docfacts.session import computed_once, materialize
from docfacts.sources.readers import parquet_or_empty

# Attempts per report, and the size asked of a provider.
MAX_ATTEMPTS = 2
MAX_TOKENS = 600

EXTRACTED, FAILED = "extracted", "failed"


class ColumnProvider:
    """``answer(prompt, attempt)`` returns the output expression of an attempt."""

    repeatable = True

    def __init__(self, answer: Callable[[Column, int], Column]):
        self.answer = answer

    def complete(self, df: DataFrame, attempt: int) -> DataFrame:
        asked = F.col("prompt").isNotNull()
        return df.withColumn("output", F.when(asked, self.answer(F.col("prompt"), attempt)))


class BatchProvider:
    """``connect()`` runs once per task and returns ``(prompts, max_tokens) -> outputs``."""

    repeatable = False

    def __init__(self, connect: Callable[[], Callable[[list[str], int], Sequence[str]]]):
        self.connect = connect

    def complete(self, df: DataFrame, attempt: int) -> DataFrame:
        connect = self.connect

        @F.pandas_udf("string")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            ask = connect()
            for prompts in batches:
                yield pd.Series(list(ask(prompts.tolist(), MAX_TOKENS)), dtype=object)

        return df.withColumn("output", run.asNondeterministic()(F.col("prompt")))


class LedgerProvider:
    """Asks another provider, and asks nothing twice: answers are kept in a ledger.

    The ledger is a Parquet table of prompt hash, attempt and output. A prompt that it has for
    an attempt is answered from there; equal prompts are asked once. A run that is repeated, or
    goes on after a failure, asks only for what is missing.
    """

    repeatable = False

    def __init__(self, source: BatchProvider, path: str):
        self.source, self.path = source, path.rstrip("/")

    def answers(self, spark: SparkSession, attempt: int) -> DataFrame:
        """``prompt_hash`` and ``output``, one row for each prompt of an attempt asked so far."""
        kept = parquet_or_empty(spark, f"{self.path}/attempt={attempt}", ANSWER)
        return kept.dropDuplicates(["prompt_hash"])

    def complete(self, df: DataFrame, attempt: int) -> DataFrame:
        spark = df.sparkSession
        hashed = df.withColumn("_hash", F.sha2(F.col("prompt"), 256))
        known = self.answers(spark, attempt).select(F.col("prompt_hash").alias("_hash"))
        new = hashed.filter(F.col("prompt").isNotNull()).select("_hash", "prompt").join(known, "_hash", "left_anti")
        asked = self.source.complete(new.dropDuplicates(["_hash"]), attempt)
        asked.select(F.col("_hash").alias("prompt_hash"), "output").write.mode("append").parquet(f"{self.path}/attempt={attempt}")
        found = self.answers(spark, attempt).withColumnRenamed("prompt_hash", "_hash")
        return hashed.join(found, "_hash", "left").drop("_hash")


def _stated_as_json(prompt: Column, attempt: int) -> Column:
    """Answer of the rule-based provider: the facts stated in the report, as JSON."""
    found = [text.stated_fact(prompt, f).alias(f) for f in RECORD_FIELDS]
    return F.to_json(F.struct(*found))


_PROVIDERS: dict[str, Callable[[], Any]] = {"rules": lambda: ColumnProvider(_stated_as_json)}


def register_provider(name: str, factory: Callable[[], Any]) -> None:
    _PROVIDERS[name] = factory


def provider(name: str = "rules") -> Any:
    if name not in _PROVIDERS:
        raise ValueError(f"unknown provider {name!r}, expected one of {sorted(_PROVIDERS)}")
    return _PROVIDERS[name]()


def extract(df: DataFrame, source: Any, attempt: int = 1) -> DataFrame:
    """One attempt: prompt, provider, JSON object, typed record.

    Reads ``context`` (the report text to show) and ``hint``; adds ``prompt``,
    ``output``, ``record`` and ``type_errors``.
    """
    prompted = df.withColumn("prompt", text.prompt(F.col("context"), F.col("hint")))
    return parse_outputs(source.complete(prompted, attempt), "output")


def _outcome(status: str, record: Column, why: Column, attempts: Column) -> list[Column]:
    return [
        F.col("report_id"),
        F.lit(status).alias("status"),
        record.alias("record"),
        why.alias("reason"),
        attempts.cast("int").alias("attempts"),
    ]


def run(
    reports: DataFrame,
    source: Any,
    rules: Sequence[Rule] = DOMAIN_RULES,
    max_attempts: int = MAX_ATTEMPTS,
    prior: DataFrame | None = None,
) -> DataFrame:
    """One outcome per report: status, record or reason, attempts.

    ``reports`` has report_id and text, and optionally ``context``. ``prior`` counts
    the attempts already used (report_id, attempts); a report that has used them all
    fails with 0 attempts and no reason.
    """
    if max_attempts < 1:
        raise ValueError("max_attempts must be at least 1")
    if "context" not in reports.columns:
        reports = reports.withColumn("context", F.col("text"))
    used = F.lit(0)
    if prior is not None:
        before = prior.select("report_id", F.col("attempts").alias("_used"))
        reports = reports.join(before, "report_id", "left")
        used = F.coalesce(F.col("_used"), F.lit(0))
    start = reports.withColumn("_before", used.cast("int")).withColumn("hint", F.lit(""))
    rounds = _rounds_in_one_pass if source.repeatable else _rounds_with_written_answers
    return rounds(start, source, rules, max_attempts)


def _rounds_in_one_pass(
    df: DataFrame, source: Any, rules: Sequence[Rule], max_attempts: int
) -> DataFrame:
    df = df.withColumns(
        {
            "_attempt": F.lit(0),
            "_errors": F.lit(None).cast("array<struct<field:string,message:string>>"),
        }
    )
    kept = [*df.columns, "_record"]
    failing = F.lit(True)
    for attempt in range(1, max_attempts + 1):
        admitted = failing & (F.col("_before") + attempt <= max_attempts)
        hint = (
            F.lit("")
            if attempt == 1
            else F.coalesce(text.retry_hint(reason(F.col("_errors"))), F.lit(""))
        )
        asked = df.withColumns({"_asked": admitted, "hint": hint}).withColumn(
            "prompt", F.when(F.col("_asked"), text.prompt(F.col("context"), F.col("hint")))
        )
        parsed = parse_outputs(source.complete(asked, attempt), "output")
        tried = check(parsed, rules, record="record")
        passed = F.col("_asked") & F.col("valid")
        earlier = F.col("_record") if attempt > 1 else F.lit(None)
        df = computed_once(
            tried,
            {
                "_record": F.when(passed, F.col("record")).otherwise(earlier),
                "_errors": F.when(F.col("_asked"), F.col("errors")).otherwise(F.col("_errors")),
                "_attempt": F.when(F.col("_asked"), F.col("_before") + attempt).otherwise(
                    F.col("_attempt")
                ),
            },
        ).select(*kept)
        failing = F.col("_record").isNull()
    done = F.col("_record").isNotNull()
    return df.select(
        "report_id",
        F.when(done, F.lit(EXTRACTED)).otherwise(F.lit(FAILED)).alias("status"),
        F.col("_record").alias("record"),
        F.when(~done, reason(F.col("_errors"))).alias("reason"),
        F.col("_attempt").cast("int").alias("attempts"),
    )


def _rounds_with_written_answers(
    df: DataFrame, source: Any, rules: Sequence[Rule], max_attempts: int
) -> DataFrame:
    nothing = F.lit(None)
    spent = df.filter(F.col("_before") >= max_attempts)
    outcomes = []
    no_record = None
    todo = df
    for attempt in range(1, max_attempts + 1):
        open_ = F.col("_before") + attempt <= max_attempts
        now = todo.filter(open_).select("report_id", "context", "hint", "_before")
        # Rows that passed need their text no more, so it is not written.
        tried = materialize(
            check(extract(now, source, attempt), rules, record="record")
            .withColumn("context", F.when(~F.col("valid"), F.col("context")))
            .select(*now.columns, "record", "errors", "valid")
        )
        number = F.col("_before") + attempt
        ok = tried.filter("valid")
        outcomes.append(ok.select(*_outcome(EXTRACTED, F.col("record"), nothing, number)))
        failed = tried.filter("NOT valid").withColumn("_why", reason(F.col("errors")))
        no_record = nothing.cast(tried.schema["record"].dataType)
        final = failed.filter(number >= max_attempts)
        outcomes.append(final.select(*_outcome(FAILED, no_record, F.col("_why"), number)))
        todo = failed.withColumn("hint", text.retry_hint(F.col("_why")))
    outcomes.append(
        spent.select(*_outcome(FAILED, no_record, nothing.cast("string"), F.lit(0)))
    )
    return reduce(DataFrame.unionByName, outcomes)


def attempt_log(outcomes: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """One row per call of the gate: report_id, attempt, allowed.

    A report that failed also logs the call that was denied, which ended its rounds.
    """
    if prior is None:
        log = outcomes.withColumn("_used", F.lit(0))
    else:
        before = prior.select("report_id", F.col("attempts").cast("int").alias("_used"))
        log = outcomes.join(before, "report_id", "left").fillna(0, ["_used"])
    last_allowed = F.greatest("_used", "attempts")
    denied = F.when(F.col("status") == FAILED, 1).otherwise(0)
    return log.select(
        "report_id",
        last_allowed.alias("_last"),
        F.explode(F.sequence(F.col("_used") + 1, last_allowed + denied)).alias("attempt"),
    ).select("report_id", "attempt", (F.col("attempt") <= F.col("_last")).alias("allowed"))


def attempts_per_report(log: DataFrame) -> DataFrame:
    return log.groupBy("report_id").agg(F.count("*").alias("attempts"))


def admit(
    attempts: DataFrame,
    order_by: str | Sequence[str],
    slice_by: Column,
    max_attempts: int = MAX_ATTEMPTS,
    prior: DataFrame | None = None,
    key: str = "report_id",
) -> DataFrame:
    """Number every attempt of a report in order and say whether it is allowed.

    Adds ``attempts`` (the counter after this attempt) and ``allowed``. ``prior`` holds
    counters of earlier runs.

    ``slice_by`` must not decrease along ``order_by`` (a coarser time, say). Attempts
    are then counted per report and slice first, the small counts become offsets, and
    each slice is numbered on its own, so that a report with a third of all attempts is
    spread over its slices instead of being sorted in one task.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    sliced = attempts.withColumn("_slice", slice_by)
    earlier = (
        Window.partitionBy(key)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    offsets = (
        sliced.groupBy(key, "_slice")
        .agg(F.count("*").alias("_n"))
        .select(key, "_slice", F.sum("_n").over(earlier).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy(key, "_slice").orderBy(*order))
    # Attempts without a key are those of one unknown report; null equals null throughout.
    offsets = offsets.withColumnsRenamed({key: "_key", "_slice": "_of_slice"})
    same = sliced[key].eqNullSafe(offsets["_key"]) & sliced["_slice"].eqNullSafe(offsets["_of_slice"])
    numbered = (
        sliced.join(offsets, same, "left")
        .withColumn("attempts", within + F.coalesce(F.col("_offset"), F.lit(0)))
        .drop("_slice", "_offset", "_key", "_of_slice")
    )
    if prior is not None:
        before = prior.select(F.col(key).alias("_key"), F.col("attempts").alias("_used"))
        numbered = (
            numbered.join(before, numbered[key].eqNullSafe(before["_key"]), "left")
            .withColumn("attempts", F.col("attempts") + F.coalesce(F.col("_used"), F.lit(0)))
            .drop("_used", "_key")
        )
    return numbered.withColumn("attempts", F.col("attempts").cast("long")).withColumn(
        "allowed", F.col("attempts") <= max_attempts
    )

