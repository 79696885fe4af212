"""Reports and model outputs derived from ``orders`` with whole-number arithmetic.

Every fact follows from the order key and the customer key, so the SQL side can state
the same rows. A site depends on the customer only: several orders report one site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The minerals in the order the derivation counts them.
MINERALS = ("Copper", "Gold", "Silver", "Zinc", "Lithium", "Nickel")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(orders: DataFrame) -> DataFrame:
    """The keys of the orders dealt out over all cores. A small file of keys is one task's input;
    what is derived from a key is far larger than the key, and so is the work on it."""
    tasks = 3 * orders.sparkSession.sparkContext.defaultParallelism
    return orders.select("o_orderkey", "o_custkey").repartition(tasks, "o_orderkey", "o_custkey")


def _decimal(value: Column, digits: int) -> Column:
    """``value`` counted in units of the last of ``digits`` decimals."""
    return (value / F.lit(10**digits)).cast(f"decimal(9,{digits})")


def facts(orders: DataFrame) -> DataFrame:
    """report_id, the six facts (numbers as decimals) and the keys they come from."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    mineral = F.array(*[F.lit(m) for m in MINERALS])[(c % 6).cast("int")]
    lat = F.lit(-250000) + (c * 37 % 500) * 100 + k % 81 - 40
    lon = F.lit(-700000) + (c * 53 % 400) * 100 + k * 7 % 81 - 40
    return orders.select(
        k.alias("k"),
        c.alias("c"),
        F.concat(F.lit("RPT-"), k.cast("string")).alias("report_id"),
        F.when(k % 23 == 0, F.lit("Unobtainium")).otherwise(mineral).alias("mineral"),
        F.when(k % 19 == 0, F.lit(50000)).otherwise(k * 13 % 381 + 20).cast("int").alias("depth_m"),
        _decimal(F.when(k % 17 == 0, F.lit(407000)).otherwise(lat), 4).alias("lat"),
        _decimal(lon, 4).alias("lon"),
        _decimal(k * 7 % 491 + 10, 2).alias("grade_g_t"),
        F.concat(F.lit("DH-"), (k % 99 + 1).cast("string")).alias("hole_id"),
    )


def records(orders: DataFrame) -> DataFrame:
    """The facts as typed records: report_id and six fields, numbers as doubles."""
    numbers = {n: F.col(n).cast("double") for n in ("depth_m", "lat", "lon", "grade_g_t")}
    return facts(orders).withColumns(numbers)


def _report_text() -> Column:
    """The facts stated in sentences."""
    # The wording of a report.
    return F.concat(
        F.lit("GEOLOGICAL SURVEY REPORT "),
        F.col("report_id"),
        F.lit("\n\nDrill hole "),
        F.col("hole_id"),
        F.lit(" intersected "),
        F.col("grade_g_t").cast("string"),
        F.lit(" g/t "),
        F.col("mineral"),
        F.lit(" at a depth of "),
        F.col("depth_m").cast("string"),
        F.lit("m. Coordinates recorded at the collar: "),
        F.col("lat").cast("string"),
        F.lit(", "),
        F.col("lon").cast("string"),
        F.lit(".\n\nField notes: core recovery was consistent throughout the interval."),
    )


def labelled(orders: DataFrame) -> DataFrame:
    """Reports with their labels: report_id, text and ``ground_truth``."""
    truth = F.struct(
        "mineral",
        "depth_m",
        *[F.col(n).cast("double").alias(n) for n in ("lat", "lon", "grade_g_t")],
        "hole_id",
    )
    return facts(orders).select(
        "report_id", _report_text().alias("text"), truth.alias("ground_truth")
    )


def reports(orders: DataFrame) -> DataFrame:
    return labelled(orders).select("report_id", "text")


def truth(orders: DataFrame) -> DataFrame:
    return labelled(orders).select("report_id", "ground_truth")


def _object(k: Column, broken: bool) -> Column:
    """The model's answer: fields as JSON, spoilt by key class when ``broken``."""
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    depth, hole, mineral = F.col("depth_m").cast("string"), F.col("hole_id"), F.col("mineral")
    if broken:
        depth = F.when(k % 7 == 0, q(depth)).when(k % 11 == 0, F.lit("null")).otherwise(depth)
        hole = F.when(k % 13 == 0, (k % 99 + 1).cast("string")).otherwise(q(hole))
    else:
        mineral = F.array(*[F.lit(m) for m in MINERALS])[(F.col("c") % 6).cast("int")]
        hole = q(hole)
    answer = F.concat(
        F.lit('{"mineral": '),
        q(mineral),
        F.lit(', "depth_m": '),
        depth,
        F.lit(', "lat": '),
        F.col("lat").cast("string"),
        F.lit(', "lon": '),
        F.col("lon").cast("string"),
        F.lit(', "grade_g_t": '),
        F.col("grade_g_t").cast("string"),
        F.lit(', "hole_id": '),
        hole,
        F.lit("}"),
    )
    if broken:
        answer = (
            F.when(k % 29 == 0, F.lit("no object"))
            .when(k % 31 == 0, F.lit('{"mineral" "Gold"}'))
            .otherwise(answer)
        )
    return answer


def outputs(orders: DataFrame) -> DataFrame:
    """Noisy model outputs: report_id, text, ``output_1`` and ``output_2``.

    The second attempt is clean for even keys and repeats the first for odd ones. Depth
    and latitude stay as derived, so some reports fail both times.
    """
    k = F.col("k")
    noisy = lambda answer: F.concat(
        F.lit("<think>draft {\n}</think>\nHere is the extraction:\n```json\n"),
        answer,
        F.lit("\n```\nLet me know if you need anything else."),
    )
    first = noisy(_object(k, broken=True))
    again = F.when(k % 2 == 0, noisy(_object(k, broken=False))).otherwise(F.col("output_1"))
    return (
        facts(orders)
        .withColumn("output_1", first)
        .withColumn("output_2", again)
        .select("k", "report_id", F.concat(F.lit("Report "), "report_id").alias("text"),
                "output_1", "output_2")
    )
