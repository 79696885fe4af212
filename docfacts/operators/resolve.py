"""Cross-document resolution of records to occurrences, and the queries on them.

Spark plan: counts and sums of a site use partial aggregates, so a site reported by a
third of all records costs one row per map task. Which reports a site rests on is a table
of its own, ``links``: a projection of the records without aggregate or shuffle, which
holds every id of every site, whatever its size.

Means don't depend on how rows are split or ordered: measures are added up as decimals,
which is exact, and sum and count stay apart until the end (``totals``), so that the totals
of several runs can be merged as well. A mean is the exact quotient as the nearest double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfacts.functions.numeric import exact_mean, exact_part, inexact_part, round_mean
from docfacts.schemas import RECORD_FIELDS

SITE = ["mineral", "lat_bucket", "lon_bucket"]
MEASURES = ("depth_m", "grade_g_t")


def with_site(records: DataFrame) -> DataFrame:
    """Add the coordinate grid cell of each record (0.01 degree)."""
    return records.withColumns({"lat_bucket": F.round("lat", 2), "lon_bucket": F.round("lon", 2)})


def totals(sited: DataFrame) -> DataFrame:
    """Count of reports, and count and exact sum of each measure, of every site.

    ``sited`` has its site columns already. Values a decimal can't hold (NaN, infinite or
    of 10^15 and more) are added up apart, as doubles.
    """
    sums = [
        column
        for name in MEASURES
        for column in (
            F.count(name).alias(f"{name}_n"),
            F.sum(exact_part(F.col(name))).alias(f"{name}_sum"),
            F.sum(inexact_part(F.col(name))).alias(f"{name}_rest"),
        )
    ]
    return sited.groupBy(*SITE).agg(F.count("*").alias("n_reports"), *sums)


def merged(parts: DataFrame) -> DataFrame:
    """One row of totals per site from the totals of several runs, put one below another."""
    kept = [name for name in parts.columns if name not in SITE]
    return parts.groupBy(*SITE).agg(
        *[F.sum(name).cast(parts.schema[name].dataType).alias(name) for name in kept]
    )


def facts_of(site_totals: DataFrame) -> DataFrame:
    """Occurrences from totals: count and the mean of each measure."""
    means = [
        exact_mean(F.col(f"{m}_sum"), F.col(f"{m}_rest"), F.col(f"{m}_n")).alias(f"avg_{m}") for m in MEASURES
    ]
    return site_totals.select(*SITE, "n_reports", *means)


def occurrences(records: DataFrame) -> DataFrame:
    """One row per site: count, mean depth and mean grade. One scan, one shuffle of partial sums."""
    return facts_of(totals(with_site(records)))


def links(records: DataFrame) -> DataFrame:
    """(site, report_id), one row for each record."""
    return with_site(records).select(*SITE, "report_id")


def stats(occ: DataFrame) -> DataFrame:
    """Records in and occurrences out; (0, 0) for no input."""
    return occ.agg(
        F.coalesce(F.sum("n_reports"), F.lit(0)).alias("n_raw_records"),
        F.count("*").alias("n_resolved_occurrences"),
    )


def by_region(occ: DataFrame) -> DataFrame:
    """Occurrences per mineral and whole-degree cell; means are unweighted over sites.

    Site means are added up to twelve decimals, exactly; see ``round_mean`` for ties.
    """
    return (
        occ.groupBy(
            "mineral",
            F.round("lat_bucket", 0).alias("region_lat"),
            F.round("lon_bucket", 0).alias("region_lon"),
        )
        .agg(
            F.count("*").alias("n_occurrences"),
            F.sum("n_reports").alias("n_source_reports"),
            *[round_mean(F.col(f"avg_{m}"), digits).alias(f"avg_{m}") for m, digits in zip(MEASURES, (1, 2))],
        )
        .orderBy(F.desc("n_occurrences"), "mineral", "region_lat", "region_lon")
    )


def search(occ: DataFrame, mineral: str | None = None) -> DataFrame:
    """Occurrences, most reported first; an absent or empty ``mineral`` means all."""
    found = occ.filter(F.col("mineral") == mineral) if mineral else occ
    return found.orderBy(F.desc("n_reports"), *SITE)


def lookup(records: DataFrame, report_id: str) -> DataFrame:
    """The stored record of one report; no row if there is none."""
    return records.filter(F.col("report_id") == report_id).select("report_id", *RECORD_FIELDS)
