"""Seeded test data at scale.

Every value is a hash of (seed, row id, field), so the rows do not depend on how Spark
partitions them and can be recomputed after a loss, unlike ``rand``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.operators.validate import VALID_MINERALS

# Ranges of the generated facts, within the validated domain.
DEPTH_RANGE = (20, 400)
LAT_RANGE = (-25.0, -20.0)
LON_RANGE = (-70.0, -66.0)
GRADE_RANGE = (0.1, 5.0)
HOLES = 99
_DRAWS = 1 << 32


def draw(seed: int, row_id: Column, field: str) -> Column:
    """A whole number in [0, 2^32), evenly spread."""
    key = F.concat_ws(":", F.lit(str(seed)), row_id.cast("string"), F.lit(field))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def _steps(value: Column, low: float, high: float, digits: int) -> Column:
    """A number in [low, high] with at most ``digits`` decimals, from whole numbers."""
    scale = 10**digits
    first, last = round(low * scale), round(high * scale)
    return (F.lit(first) + value % F.lit(last - first + 1)) / F.lit(float(scale))


def label(ids: DataFrame, id_col: str = "id", seed: int = 42) -> DataFrame:
    """A labelled report for every id: report_id, text, ground_truth."""
    row_id = F.col(id_col)
    minerals = F.array(*[F.lit(m) for m in VALID_MINERALS])
    low, high = DEPTH_RANGE
    facts = ids.select(
        F.format_string("RPT-%03d", row_id.cast("bigint")).alias("report_id"),
        minerals[(draw(seed, row_id, "mineral") % len(VALID_MINERALS)).cast("int")].alias(
            "mineral"
        ),
        (low + draw(seed, row_id, "depth_m") % (high - low + 1)).cast("int").alias("depth_m"),
        _steps(draw(seed, row_id, "lat"), *LAT_RANGE, 4).alias("lat"),
        _steps(draw(seed, row_id, "lon"), *LON_RANGE, 4).alias("lon"),
        _steps(draw(seed, row_id, "grade_g_t"), *GRADE_RANGE, 2).alias("grade_g_t"),
        F.concat(
            F.lit("DH-"), (draw(seed, row_id, "hole_id") % HOLES + 1).cast("string")
        ).alias("hole_id"),
    )
    # Fixed value: the wording of a generated report.
    text = F.format_string(
        "GEOLOGICAL SURVEY REPORT %s\n\n"
        "Drill hole %s intersected %s g/t %s at a depth of %sm. "
        "Coordinates recorded at the collar: %s, %s.\n\n"
        "Field notes: core recovery was consistent throughout the interval. "
        "Sample was logged by the site geologist and sent for assay confirmation. "
        "No significant alteration was observed above %sm.",
        "report_id",
        "hole_id",
        F.col("grade_g_t").cast("string"),
        "mineral",
        F.col("depth_m").cast("string"),
        F.col("lat").cast("string"),
        F.col("lon").cast("string"),
        (F.col("depth_m") - 15).cast("string"),
    )
    truth = F.struct("mineral", "depth_m", "lat", "lon", "grade_g_t", "hole_id")
    return facts.select("report_id", text.alias("text"), truth.alias("ground_truth"))


def reports(spark: SparkSession, n: int = 15, seed: int = 42) -> DataFrame:
    return label(spark.range(n), "id", seed)


def skewed_index(
    df: DataFrame,
    n_items: int | Column,
    id_col: str = "id",
    hot_fraction: float = 0.05,
    hot_weight: float = 0.6,
    seed: int = 42,
) -> DataFrame:
    """Add ``item_index`` (0-based): the first ``hot_fraction`` of the items get
    ``hot_weight`` of the picks, the others share the rest."""
    n = F.lit(n_items).cast("bigint") if isinstance(n_items, int) else n_items.cast("bigint")
    n_hot = F.greatest(F.lit(1), F.floor(n * F.lit(hot_fraction))).cast("bigint")
    which = draw(seed, F.col(id_col), "hot")
    pick = draw(seed, F.col(id_col), "pick")
    hot = (which < int(hot_weight * _DRAWS)) | (n == n_hot)
    index = F.when(hot, pick % n_hot).otherwise(n_hot + pick % F.greatest(n - n_hot, F.lit(1)))
    return df.withColumn("item_index", index)


def skewed(
    df: DataFrame,
    items: Sequence,
    id_col: str = "id",
    hot_fraction: float = 0.05,
    hot_weight: float = 0.6,
    seed: int = 42,
) -> DataFrame:
    """Add ``item``, picked from a short list with the skew of ``skewed_index``."""
    values = F.array(*[F.lit(x) for x in items])
    indexed = skewed_index(df, len(items), id_col, hot_fraction, hot_weight, seed)
    return indexed.withColumn("item", values[F.col("item_index").cast("int")]).drop("item_index")
