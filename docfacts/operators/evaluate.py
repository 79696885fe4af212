"""Field-by-field comparison of extraction outcomes with labelled truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfacts.functions.numeric import share
from docfacts.operators.extract import EXTRACTED
from docfacts.schemas import NUMBER_FIELDS, RECORD_FIELDS

# Fixed value: numbers closer than this are the same.
TOLERANCE = 0.01


def same(field: str, predicted: Column, truth: Column) -> Column:
    """Never null: a missing value equals only a missing value."""
    if field not in NUMBER_FIELDS:
        return predicted.eqNullSafe(truth)
    both = predicted.isNotNull() & truth.isNotNull()
    close = F.abs(predicted - truth.cast("double")) < TOLERANCE
    # NaN is close to nothing, as the comparison of floats has it.
    close = close & ~F.isnan(predicted) & ~F.isnan(truth.cast("double"))
    return F.when(both, close).otherwise(predicted.isNull() & truth.isNull())


def field_matches(outcomes: DataFrame, truth: DataFrame) -> DataFrame:
    """One row per labelled report: status, attempts and ``field_matches``.

    ``outcomes`` comes from ``extract.run``; ``truth`` has report_id and a
    ``ground_truth`` struct. A report that failed or has no outcome matches nothing.
    """
    predicted = outcomes.select("report_id", "status", "record", "attempts")
    labels = truth.select("report_id", "ground_truth")
    extracted = F.coalesce(F.col("status") == EXTRACTED, F.lit(False))
    matches = [
        F.when(extracted, same(f, F.col("record")[f], F.col("ground_truth")[f]))
        .otherwise(F.lit(False))
        .alias(f)
        for f in RECORD_FIELDS
    ]
    return labels.join(predicted, "report_id", "left").select(
        "report_id",
        F.coalesce("status", F.lit("failed")).alias("status"),
        F.coalesce("attempts", F.lit(0)).alias("attempts"),
        F.struct(*matches).alias("field_matches"),
    )


def summary(matches: DataFrame) -> DataFrame:
    """One row: conformance, field precision over all reports, mean attempts."""
    correct = sum(
        (F.col("field_matches")[f].cast("int") for f in RECORD_FIELDS), F.lit(0)
    )
    n, n_extracted = F.col("n_reports"), F.col("n_extracted")
    return matches.agg(
        F.count("*").alias("n_reports"),
        F.coalesce(F.sum((F.col("status") == EXTRACTED).cast("int")), F.lit(0)).alias(
            "n_extracted"
        ),
        F.sum(correct).alias("_correct"),
        F.sum("attempts").alias("_attempts"),
    ).select(
        "n_reports",
        "n_extracted",
        share(n_extracted, n).alias("schema_conformance_rate"),
        share(F.col("_correct"), n * len(RECORD_FIELDS)).alias("field_level_precision"),
        share(F.col("_attempts"), n, 2).alias("avg_attempts"),
    )
