import json

import pytest
from pyspark.sql import functions as F

from docfacts.operators import extract, validate
from docfacts.schemas import ATTEMPT, RECORD

BASE = {
    "mineral": "Copper", "depth_m": 150.0, "lat": -22.5, "lon": -68.0, "grade_g_t": 1.5,
    "hole_id": "DH-14",
}


def check_one(spark, **changes):
    df = spark.createDataFrame([tuple({**BASE, **changes}.values())], RECORD)
    return validate.check(df).withColumn("reason", validate.reason(F.col("errors"))).first()


def test_base_record_is_valid(spark):
    assert check_one(spark).valid


@pytest.mark.parametrize(
    "changes, fields, words",
    [
        ({"mineral": "Unobtainium"}, ["mineral"], "not a recognized mineral"),
        ({"mineral": "copper"}, ["mineral"], "not a recognized mineral"),
        ({"depth_m": -50.0}, ["depth_m"], "out of plausible range"),
        ({"depth_m": 0.0}, ["depth_m"], "out of plausible range"),
        ({"depth_m": 50000.0}, ["depth_m"], "out of plausible range"),
        ({"depth_m": float("nan")}, ["depth_m"], "out of plausible range"),
        ({"lat": 40.7, "lon": -74.0}, ["lat"], "outside survey region bounds"),
        ({"lat": float("nan"), "lon": float("inf")}, ["lat", "lon"], "outside survey region"),
        ({"lat": None}, ["lat"], "field required"),
    ],
)
def test_invalid_records_say_why(spark, changes, fields, words):
    row = check_one(spark, **changes)
    assert not row.valid and [e.field for e in row.errors] == fields and words in row.reason


@pytest.mark.parametrize(
    "changes",
    [{"depth_m": 1000.0}, {"lat": -30.0, "lon": -75.0}, {"lat": -15.0, "lon": -60.0},
     {"grade_g_t": float("nan")}],
)
def test_bounds_are_closed_and_grade_has_no_rule(spark, changes):
    assert check_one(spark, **changes).valid


def test_own_rules(spark):
    rule = validate.Rule("grade_g_t", lambda c: c < 1, lambda c: F.lit("grade too high"))
    df = validate.check(spark.createDataFrame([tuple(BASE.values())], RECORD), [rule])
    valid, quarantined = validate.split(df)
    assert valid.count() == 0 and quarantined.first().reason == "grade too high"


GOOD, BAD = json.dumps(BASE), json.dumps({**BASE, "lat": 40.7})


def reports(spark, *rows):
    return spark.createDataFrame(list(rows), "report_id string, text string, answers array<string>")


REPLAY = extract.ColumnProvider(lambda prompt, attempt: F.col("answers")[attempt - 1])


def test_only_failures_are_retried(spark):
    df = reports(
        spark, ("first", "t", [GOOD, "never asked"]), ("second", "t", [BAD, GOOD]),
        ("neither", "t", [BAD, "no braces"]),
    )
    out = {r.report_id: r for r in extract.run(df, REPLAY).collect()}
    assert (out["first"].status, out["first"].attempts) == ("extracted", 1)
    assert (out["second"].status, out["second"].attempts) == ("extracted", 2)
    assert out["second"].record.asDict() == BASE and out["second"].reason is None
    failed = out["neither"]
    assert (failed.status, failed.attempts, failed.record) == ("failed", 2, None)
    assert "no JSON object" in failed.reason, "the last reason is kept"


def test_partitioning_does_not_matter(spark):
    rows = [(f"r{i}", "t", [GOOD if i % 3 else BAD, GOOD if i % 2 else BAD]) for i in range(60)]
    df = reports(spark, *rows)
    one = extract.run(df.coalesce(1), REPLAY).orderBy("report_id").collect()
    eight = extract.run(df.repartition(8), REPLAY).orderBy("report_id").collect()
    assert one == eight and len(one) == 60


def test_used_up_attempts(spark):
    prior = spark.createDataFrame([("spent", 2), ("half", 1)], ATTEMPT)
    df = reports(spark, ("spent", "t", [GOOD, GOOD]), ("half", "t", [BAD, GOOD]), ("new", "t", [GOOD, GOOD]))
    out = {r.report_id: r for r in extract.run(df, REPLAY, prior=prior).collect()}
    assert (out["spent"].status, out["spent"].attempts, out["spent"].reason) == ("failed", 0, None)
    assert (out["half"].status, out["half"].attempts) == ("failed", 2)
    assert (out["new"].status, out["new"].attempts) == ("extracted", 1)
    outcomes = extract.run(df, REPLAY, prior=prior)
    log = extract.attempt_log(outcomes, prior)
    calls = {r.report_id: r.attempts for r in extract.attempts_per_report(log).collect()}
    assert calls == {"spent": 1, "half": 2, "new": 1}, "a failed report logs its denied call"


def batch_provider(calls):
    """Answers well when the prompt carries a hint; counts what it is asked."""
    good, bad = GOOD, BAD

    def connect():
        def ask(prompts, max_tokens):
            calls.add(len(prompts))
            return [
                bad if "hopeless" in p else good if "Note:" in p or "easy" in p else bad
                for p in prompts
            ]

        return ask

    return extract.BatchProvider(connect)


def test_batch_provider_is_asked_once_per_attempt(spark):
    calls = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame(
        [(f"r{i}", ["easy", "hard", "hopeless"][i % 3]) for i in range(30)],
        "report_id string, text string",
    )
    out = extract.run(df, batch_provider(calls))
    for _ in range(2):  # further actions ask nothing again
        got = {(r.status, r.attempts): r["count"] for r in out.groupBy("status", "attempts").count().collect()}
    assert got == {("extracted", 1): 10, ("extracted", 2): 10, ("failed", 2): 10}
    assert calls.value == 30 + 20
    assert out.filter("status = 'failed'").first().reason.startswith("lat=40.7 outside survey")


def test_both_provider_kinds_agree(spark):
    df = spark.createDataFrame([(f"r{i}", ["easy", "hard", "hopeless"][i % 3]) for i in range(9)],
                               "report_id string, text string")
    prior = spark.createDataFrame([("r0", 2), ("r1", 1), ("r2", 1)], ATTEMPT)
    answer = extract.ColumnProvider(
        lambda p, attempt: F.when(p.contains("hopeless"), F.lit(BAD))
        .when(p.contains("Note:") | p.contains("easy"), F.lit(GOOD))
        .otherwise(F.lit(BAD))
    )
    calls = spark.sparkContext.accumulator(0)
    a = extract.run(df, answer, prior=prior).orderBy("report_id").collect()
    b = extract.run(df, batch_provider(calls), prior=prior).orderBy("report_id").collect()
    assert a == b


def test_provider_that_never_cooperates(spark):
    idle = extract.ColumnProvider(lambda p, n: F.lit('{"answer": "none", "confidence": 0.5}'))
    df = spark.createDataFrame([("x", "Some report text.")], "report_id string, text string")
    row = extract.run(df, idle).first()
    assert (row.status, row.attempts) == ("failed", 2) and "mineral: field required" in row.reason


def test_providers_by_name(spark):
    with pytest.raises(ValueError, match="unknown provider"):
        extract.provider("nobody")
    extract.register_provider("idle", lambda: REPLAY)
    assert extract.provider("idle") is REPLAY


def test_admission_equals_one_sorted_task(spark):
    """A third of the attempts belong to one report; slices must not change the numbers."""
    df = spark.range(900).selectExpr(
        "id", "IF(id % 3 = 0, 'hot', concat('r', id % 40)) AS report_id", "id * 37 % 901 AS at"
    )
    prior = spark.createDataFrame([("hot", 1), ("r1", 5)], ATTEMPT)
    rows = extract.admit(df, ["at", "id"], F.floor(F.col("at") / 50), prior=prior).collect()
    seen = {"hot": 1, "r1": 5}
    for row in sorted(rows, key=lambda r: (r.at, r.id)):
        seen[row.report_id] = seen.get(row.report_id, 0) + 1
        assert row.attempts == seen[row.report_id] and row.allowed == (row.attempts <= 2)
    assert len(rows) == 900


def test_ledger_asks_nothing_twice(spark, tmp_path):
    """Equal prompts are asked once, a second run asks only for new reports, a retry has its own answers."""
    log = tmp_path / "asked"

    def connect():
        def ask(prompts, max_tokens):
            with open(log, "a") as file:
                file.writelines("x" for _ in prompts)
            fact = '{"mineral": "Gold", "depth_m": %s, "lat": -22.5, "lon": -68.1, "grade_g_t": 2.5, "hole_id": "DH-1"}'
            return [fact % ("50000" if "hard" in p and "Note: " not in p else "100") for p in prompts]

        return ask

    texts = {f"r{i}": ("easy report", "hard report", f"own hard report {i}")[i % 3] for i in range(30)}
    df = spark.createDataFrame(list(texts.items()), "report_id string, text string")
    provider = extract.LedgerProvider(extract.BatchProvider(connect), str(tmp_path / "ledger"))
    outcome = lambda some: {r.report_id: (r.status, r.attempts) for r in extract.run(some, provider).collect()}
    want = {k: ("extracted", 2 if "hard" in t else 1) for k, t in texts.items()}
    assert outcome(df) == want
    asked = len(log.read_text())
    assert asked == 12 + 11, "12 different prompts, 11 of them again with a hint"
    assert outcome(df.repartition(5)) == want and len(log.read_text()) == asked
    more = df.unionByName(spark.createDataFrame([("new", "another easy one")], df.schema))
    assert outcome(more) == want | {"new": ("extracted", 1)} and len(log.read_text()) == asked + 1
