"""Intake: validate uploads, fingerprint the text, let the first copy of a text in.

Spark plan: the texts are hashed in the scan stage and only hash and order key are
shuffled to find the first arrival of each hash, with a partial aggregate before the
shuffle, so a text that makes up a third of all uploads costs one row per map task.
The verdict is joined back on hash and arrival, which is as spread as the arrivals are,
and copies with the same arrival are numbered within it. The text column takes part in
that join only if the caller keeps it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Limit in bytes, outcomes and the error of a short text.
MIN_TEXT_BYTES = 20
ACCEPTED, DUPLICATE, REJECTED = "accepted", "duplicate", "rejected"
TOO_SHORT = "document text too short to be a real report"
HTTP_STATUS = {ACCEPTED: 200, DUPLICATE: 409, REJECTED: 400}


def content_hash(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text as it is."""
    return F.sha2(text, 256)


def upload_error(report_id: Column, text: Column, malformed: Column | None = None) -> Column:
    """Why an upload is rejected; null if it may go on to deduplication."""
    missing = lambda c: c.isNull() | (c == "")
    error = (
        F.when(missing(report_id), F.lit("report_id is required"))
        .when(missing(text), F.lit("text is required"))
        .when(F.octet_length(text) < MIN_TEXT_BYTES, F.lit(TOO_SHORT))
    )
    if malformed is not None:
        error = F.when(malformed.isNotNull(), F.lit("body is not valid JSON")).otherwise(error)
    return error


def checked(uploads: DataFrame) -> DataFrame:
    """Add ``error`` and, for rows without one, ``content_hash``.

    A ``_corrupt_record`` column left by the JSON reader makes its rows rejections.
    """
    malformed = F.col("_corrupt_record") if "_corrupt_record" in uploads.columns else None
    error = upload_error(F.col("report_id"), F.col("text"), malformed)
    return uploads.withColumn("error", error).withColumn(
        "content_hash", F.when(F.col("error").isNull(), content_hash(F.col("text")))
    )


def gate(
    uploads: DataFrame, order_by: str | Sequence[str], registry: DataFrame | None = None
) -> DataFrame:
    """Add ``content_hash``, ``status`` and ``error`` to every upload.

    ``order_by`` names the arrival order. Of copies that arrive together one is let in;
    every upload gets exactly one verdict.
    ``registry`` holds the hashes of earlier runs; a known hash makes every copy a
    duplicate.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    # One plain column keeps the aggregate below hash-based.
    arrival = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    # Shuffled as bytes, a hash takes half the room of its digits, which nothing compresses. As a struct, a
    # null arrival equals another, so one deal by hash and arrival serves the join and the numbering.
    rows = checked(uploads).withColumn("_digest", F.unhex("content_hash")).drop("content_hash")
    digits = F.lower(F.hex("_digest"))
    first = rows.filter(F.col("error").isNull()).groupBy("_digest").agg(F.min(arrival).alias("_arrival"))
    if registry is not None:
        known = registry.select("content_hash")
        first = first.withColumn("content_hash", digits).join(known, "content_hash", "left_anti").drop("content_hash")
    winners = first.select(
        F.col("_digest").alias("_hash"), F.struct(F.col("_arrival").alias("at")).alias("_earliest"), F.lit(True).alias("_first")
    )
    dealt = rows.withColumn("_at", F.struct(arrival.alias("at")))
    together = F.row_number().over(Window.partitionBy("_digest", "_at").orderBy("_at"))
    status = (
        F.when(F.col("error").isNotNull(), F.lit(REJECTED))
        .when(F.col("_first") & (F.col("_nth") == 1), F.lit(ACCEPTED))
        .otherwise(F.lit(DUPLICATE))
    )
    return (
        dealt.join(winners, (F.col("_digest") == F.col("_hash")) & (F.col("_at") == F.col("_earliest")), "left")
        .withColumn("_nth", together)
        .withColumn("status", status)
        .withColumn("content_hash", digits)
        .select(*uploads.columns, "content_hash", "status", "error")
    )


def with_response(gated: DataFrame) -> DataFrame:
    """Add the response code an uploader gets for each status."""
    pairs = [F.lit(x) for item in HTTP_STATUS.items() for x in item]
    return gated.withColumn("status_code", F.create_map(*pairs)[F.col("status")])


def new_hashes(gated: DataFrame) -> DataFrame:
    """Registry rows to append after a run."""
    return gated.filter(F.col("status") == ACCEPTED).select("content_hash", "report_id")


def accepted_documents(gated: DataFrame) -> DataFrame:
    """The documents to store; only their keys if the verdicts were kept without the text."""
    kept = [c for c in ("report_id", "text", "content_hash") if c in gated.columns]
    return gated.filter(F.col("status") == ACCEPTED).select(*kept)


def candidates(uploads: DataFrame) -> DataFrame:
    """The documents that a gate may let in, with their hashes."""
    return checked(uploads).filter(F.col("error").isNull()).select("report_id", "text", "content_hash")


def summary(gated: DataFrame) -> DataFrame:
    """Uploads per status."""
    return gated.groupBy("status").agg(F.count("*").alias("n_uploads"))
