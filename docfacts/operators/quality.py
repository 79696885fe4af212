"""Scored data-quality checks.

The measured values are aggregates over the data, so a checks frame has one row per
check; only that frame is ever collected.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfacts.functions.numeric import share
from docfacts.schemas import CHECK

# The dimensions, in report order.
DIMENSIONS = ("completeness", "correctness", "consistency", "validity", "timeliness")


@dataclass(frozen=True)
class Measure:
    """An aggregate over a stage and the threshold it has to reach."""

    dimension: str
    name: str
    measured: Column
    threshold: float
    higher_is_better: bool = True
    detail: str = ""


def measure(df: DataFrame, *wanted: Measure) -> DataFrame:
    """One row per measure. All of them come from a single pass over ``df``."""
    for m in wanted:
        if m.dimension not in DIMENSIONS:
            raise ValueError(f"unknown dimension {m.dimension!r}, expected one of {DIMENSIONS}")
    totals = df.agg(
        *[m.measured.cast("double").alias(f"_measured_{i}") for i, m in enumerate(wanted)]
    )
    rows = [
        F.struct(
            F.lit(m.dimension).alias("dimension"),
            F.lit(m.name).alias("name"),
            F.col(f"_measured_{i}").alias("measured"),
            F.lit(float(m.threshold)).alias("threshold"),
            F.lit(m.detail).alias("detail"),
            F.lit(m.higher_is_better).alias("higher_is_better"),
        )
        for i, m in enumerate(wanted)
    ]
    return totals.select(F.inline(F.array(*rows)))


class Suite:
    """Checks of a run, measured while its stages are written.

    ``stage`` attaches measures to a DataFrame as observed metrics: they are computed by the job
    that writes it, without a pass of their own. ``timed`` measures how long a part of the run
    takes. ``checks`` is called when all stages were written.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._observed: list[tuple[Observation, tuple[Measure, ...]]] = []
        self._taken: list[tuple] = []

    def stage(self, df: DataFrame, *wanted: Measure) -> DataFrame:
        seen = Observation()
        self._observed.append((seen, wanted))
        return df.observe(seen, *[m.measured.cast("double").alias(f"m{i}") for i, m in enumerate(wanted)])

    @contextmanager
    def timed(self, name: str, limit: float) -> Iterator[None]:
        start = time.monotonic()
        yield
        took = time.monotonic() - start
        self._taken.append(("timeliness", name, took, float(limit), "seconds", False))

    def checks(self) -> DataFrame:
        rows = [
            (m.dimension, m.name, seen.get[f"m{i}"], float(m.threshold), m.detail, m.higher_is_better)
            for seen, wanted in self._observed
            for i, m in enumerate(wanted)
        ]
        schema = T.StructType([CHECK[n] for n in ("dimension", "name", "measured", "threshold", "detail", "higher_is_better")])
        return evaluate(self.spark.createDataFrame(rows + self._taken, schema))


def evaluate(measures: DataFrame | list[DataFrame]) -> DataFrame:
    """Add ``passed``: reaching the threshold counts as passing, in either direction."""
    if isinstance(measures, list):
        measures = reduce(DataFrame.unionByName, measures)
    measured, threshold = F.col("measured"), F.col("threshold")
    # NaN stands above all numbers in Spark's order; as a measured value it reaches nothing.
    passed = ~F.isnan(measured) & F.when(F.col("higher_is_better"), measured >= threshold).otherwise(
        measured <= threshold
    )
    return measures.withColumn("passed", F.coalesce(passed, F.lit(False))).select(
        *[f.name for f in CHECK.fields]
    )


def score(checks: DataFrame) -> DataFrame:
    """Passed share per dimension in report order, then ``overall`` (0 without checks).

    The dimensions are folded into one row, of five entries at most, so that the checks
    are computed once and an empty frame still has its overall score.
    """
    by_dimension = checks.groupBy("dimension").agg(
        F.sum(F.col("passed").cast("int")).alias("_passed"), F.count("*").alias("_made")
    )
    rank = F.array_position(F.array(*[F.lit(d) for d in DIMENSIONS]), F.col("dimension"))
    entry = F.struct(
        rank.alias("rank"), "dimension", share(F.col("_passed"), F.col("_made")).alias("score")
    )
    overall = F.struct(
        F.lit(len(DIMENSIONS) + 1).cast("bigint").alias("rank"),
        F.lit("overall").alias("dimension"),
        share(F.col("_passed"), F.col("_made")).alias("score"),
    )
    return (
        by_dimension.agg(
            F.array_sort(F.collect_list(entry)).alias("_entries"),
            F.sum("_passed").alias("_passed"),
            F.sum("_made").alias("_made"),
        )
        .select(F.inline(F.concat("_entries", F.array(overall))))
        .select("dimension", "score")
    )


def counts(checks: DataFrame) -> DataFrame:
    """Checks passed and made."""
    return checks.agg(
        F.coalesce(F.sum(F.col("passed").cast("int")), F.lit(0)).alias("n_passed"),
        F.count("*").alias("n_checks"),
    )


def failed(checks: DataFrame) -> DataFrame:
    return checks.filter(~F.col("passed"))


class QualityError(AssertionError):
    """Checks that did not pass; ``failures`` has a line for each."""

    def __init__(self, pipeline: str, made: int, failures: list[str]):
        self.failures = failures
        super().__init__(f"{pipeline} misses {len(failures)} of {made} checks: " + "; ".join(failures))


def require(checks: DataFrame, pipeline: str = "docfacts") -> None:
    """Raise ``QualityError`` unless all checks passed. Only the failed ones reach the driver."""
    limit = F.when(F.col("higher_is_better"), F.lit("at least ")).otherwise(F.lit("at most "))
    line = F.concat(
        "dimension", F.lit("/"), "name", F.lit(": got "), F.coalesce(F.col("measured").cast("string"), F.lit("nothing")),
        F.lit(", needs "), limit, F.col("threshold").cast("string"),
        F.when(F.coalesce("detail", F.lit("")) != "", F.concat(F.lit(" ("), "detail", F.lit(")"))).otherwise(F.lit("")),
    )
    missed = [row[0] for row in failed(checks).orderBy("dimension", "name").select(line).collect()]
    if missed:
        raise QualityError(pipeline, counts(checks).first()["n_checks"], missed)
