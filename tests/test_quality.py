import random
import time

import pytest
from pyspark.sql import functions as F

from docfacts.operators import evaluate, quality, resolve
from docfacts.schemas import CHECK
from docfacts.sources import writers


def checks(spark, *rows):
    """rows: dimension, name, measured, threshold, higher_is_better, detail"""
    schema = "dimension string, name string, measured double, threshold double, higher_is_better boolean, detail string"
    return quality.evaluate(spark.createDataFrame(list(rows), schema))


def verdicts(df):
    return {r.name: r.passed for r in df.collect()}


def scores(df):
    return [(r.dimension, r.score) for r in quality.score(df).collect()]


@pytest.mark.parametrize("offset, higher, lower", [(-0.5, False, True), (0.0, True, True), (0.5, True, False)])
def test_a_threshold_counts_as_reached(spark, offset, higher, lower):
    df = checks(spark, ("validity", "up", 7.5 + offset, 7.5, True, ""), ("validity", "down", 7.5 + offset, 7.5, False, ""))
    assert verdicts(df) == {"up": higher, "down": lower}


def test_nothing_measured_reaches_nothing(spark):
    none = [("validity", f"{name}-{up}", value, 0.0, up, "") for name, value in (("nan", float("nan")), ("null", None)) for up in (True, False)]
    assert not any(verdicts(checks(spark, *none)).values())


def test_scores_by_dimension(spark):
    rng = random.Random(8)
    made = [(rng.choice(quality.DIMENSIONS[1:]), f"c{i}", float(rng.random() < 0.6), 1.0, True, "") for i in range(25)]
    df = checks(spark, *made)
    share = lambda rows: round(sum(r[2] for r in rows) / len(rows), 4)
    want = [(d, share([r for r in made if r[0] == d])) for d in quality.DIMENSIONS if any(r[0] == d for r in made)]
    assert scores(df) == [*want, ("overall", share(made))]
    assert tuple(quality.counts(df).first()) == (sum(r[2] for r in made), 25)


def test_no_checks(spark):
    none = spark.createDataFrame([], CHECK)
    assert scores(none) == [("overall", 0.0)] and tuple(quality.counts(none).first()) == (0, 0)
    quality.require(none)


def test_required_checks(spark):
    df = checks(
        spark, ("validity", "sites", 3.0, 5.0, True, "merged too far"), ("completeness", "chunks", 4.0, 1.0, True, ""),
        ("timeliness", "delay", None, 60.0, False, ""),
    )
    with pytest.raises(quality.QualityError) as error:
        quality.require(df, "survey")
    assert error.value.failures == [
        "timeliness/delay: got nothing, needs at most 60.0", "validity/sites: got 3.0, needs at least 5.0 (merged too far)",
    ]
    assert str(error.value).startswith("survey misses 2 of 3 checks: ")
    quality.require(df.filter("passed"))


def test_resolution_takes_less_than_its_limit(spark):
    """Timeliness: wall time of the resolve step on 20,000 records, with the limit of the survey."""
    df = spark.range(20_000).selectExpr(
        "concat('r', id) AS report_id", "'Gold' AS mineral", "1D AS depth_m", "CAST(-20 - (id % 900) / 100 AS double) AS lat",
        "-68D AS lon", "2D AS grade_g_t", "'DH' AS hole_id",
    )
    start = time.perf_counter()
    resolve.occurrences(df).write.format("noop").mode("overwrite").save()
    taken = ("timeliness", "resolve_seconds", time.perf_counter() - start, 120.0, False, "wall time of the resolve step")
    quality.require(checks(spark, taken))


def test_measures_share_one_pass(spark):
    df = quality.measure(
        spark.range(10),
        quality.Measure("completeness", "rows", F.count("*"), 10),
        quality.Measure("validity", "largest", F.max("id"), 8, higher_is_better=False, detail="d"),
    )
    out = {r.name: (r.measured, r.passed, r.detail) for r in quality.evaluate(df).collect()}
    assert out == {"rows": (10.0, True, ""), "largest": (9.0, False, "d")}
    with pytest.raises(ValueError, match="unknown dimension"):
        quality.measure(spark.range(1), quality.Measure("beauty", "x", F.count("*"), 1))


def test_quality_files_hold_measured_values(spark, tmp_path):
    df = checks(spark, ("correctness", "dedup_rate", 0.081, 0.005, False, "delta"))
    writers.write_quality(df, str(tmp_path / "nested" / "quality"), "t")
    row = spark.read.json(str(tmp_path / "nested" / "quality" / "checks")).first()
    assert (row.pipeline, row.measured, row.threshold, row.passed) == ("t", 0.081, 0.005, False)
    assert row.generated_at
    overall = spark.read.json(str(tmp_path / "nested" / "quality" / "score"))
    assert {r.dimension: r.score for r in overall.collect()} == {"correctness": 0.0, "overall": 0.0}


RECORD = "struct<mineral: string, depth_m: double, lat: double, lon: double, grade_g_t: double, hole_id: string>"
OUTCOME = f"report_id string, status string, record {RECORD}, reason string, attempts int"
TRUTH = "report_id string, ground_truth struct<mineral: string, depth_m: int, lat: double, lon: double, grade_g_t: double, hole_id: string>"


def test_field_matches_and_summary(spark):
    truth = spark.createDataFrame(
        [(i, ("Gold", 100, -22.5, -68.0, 2.0, "DH-1")) for i in ("right", "near", "failed", "absent")],
        TRUTH,
    )
    outcomes = spark.createDataFrame(
        [
            ("right", "extracted", ("Gold", 100.0, -22.5, -68.0, 2.0, "DH-1"), None, 1),
            ("near", "extracted", ("gold", 100.009, -22.51, None, float("nan"), "DH-1"), None, 2),
            ("failed", "failed", None, "why", 2),
        ],
        OUTCOME,
    )
    matches = evaluate.field_matches(outcomes, truth)
    rows = {r.report_id: r for r in matches.collect()}
    assert all(rows["right"].field_matches)
    assert list(rows["near"].field_matches) == [False, True, False, False, False, True]
    assert not any(rows["failed"].field_matches) and not any(rows["absent"].field_matches)
    assert tuple(evaluate.summary(matches).first()) == (4, 2, 0.5, 0.3333, 1.25)


def test_summary_of_nothing(spark):
    matches = evaluate.field_matches(spark.createDataFrame([], OUTCOME), spark.createDataFrame([], TRUTH))
    assert tuple(evaluate.summary(matches).first()) == (0, 0, 0.0, 0.0, 0.0)


def test_suite_measures_while_stages_are_written(spark, tmp_path):
    suite = quality.Suite(spark)
    ran = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        ran.add(1)
        return x

    stage = suite.stage(
        spark.range(100).select(counted("id").alias("id")),
        quality.Measure("validity", "small", F.avg((F.col("id") < 90).cast("int")), 0.9),
        quality.Measure("completeness", "gone", F.count_if(F.col("id") > 97), 1.0, higher_is_better=False),
    )
    stage.write.parquet(str(tmp_path / "stage"))
    with suite.timed("quick", 60):
        pass
    with suite.timed("never", -1):
        pass
    checks = {r["name"]: (r.dimension, r.passed) for r in suite.checks().collect()}
    assert checks == {"small": ("validity", True), "gone": ("completeness", False), "quick": ("timeliness", True), "never": ("timeliness", False)}
    assert ran.value == 100, "the measures took no pass of their own"
