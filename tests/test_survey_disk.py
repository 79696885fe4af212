"""What a run over many stages leaves on disk while it goes on."""

import random

import pytest
from pyspark.sql import functions as F

from docfacts.operators import intake
from docfacts.plans import catalog
from docfacts.session import shuffles_let_go
from docfacts.sources.prefixed import PrefixedTable

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def exchanges(df):
    """Column names of what each shuffle of a plan writes; a shuffle that is used again counts once."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if " Exchange " in f" {line.lstrip(' :+-')} " and "Reused" not in line]


def test_intake_deals_rows_out_once(spark):
    """One shuffle for the first arrivals, one of these and one of the rows, whose hashes go as bytes."""
    with_text = [(f"r{i}", f"a text of some length {i % 3}") for i in range(9)]
    df = spark.createDataFrame(with_text, "report_id string, text string")
    plan = intake.gate(df, "report_id").drop("text")
    assert len(exchanges(plan)) == 3
    assert not any("content_hash" in line or "text#" in line for line in exchanges(plan))


def test_intake_with_and_without_an_arrival(spark):
    """Copies without an arrival are the earliest only where no copy has one."""
    rows = [(2, "A" * 20), (1, "A" * 20), (None, "A" * 20), (None, "B" * 20), (None, "B" * 20), (3, "short"), (None, None), (1, "A" * 20)]
    df = spark.createDataFrame([(at, f"r{i}", text) for i, (at, text) in enumerate(rows)], "at long, report_id string, text string")
    for order in ("at", ["at", "at"]):
        found = {r.report_id: (r.status, r.content_hash) for r in intake.gate(df, order).collect()}
        assert len(found) == 8 and [found[r][0] for r in ("r0", "r5", "r6")] == ["duplicate", "rejected", "rejected"]
        statuses = lambda *ids: sorted(found[r][0] for r in ids)
        assert statuses("r3", "r4") == ["accepted", "duplicate"]
        if order == "at":
            assert statuses("r1", "r7") == ["accepted", "duplicate"] and found["r2"][0] == "duplicate"
        want = df.select("report_id", F.when(F.octet_length("text") >= 20, F.sha2("text", 256)).alias("h"))
        assert {r.report_id: r.h for r in want.collect()} == {r: h for r, (_, h) in found.items()}


@pytest.mark.parametrize("among", [False, True])
def test_one_put_is_read_without_a_shuffle(spark, tmp_path, among):
    """Also of keys that come twice, of which one row is kept; computed columns follow their own row."""
    schema = spark.createDataFrame([], "k string, text string, h string").schema
    table = PrefixedTable(spark, str(tmp_path / "t"), schema, "k", digits=1)
    rows = [(None if i == 0 else f"k{i}", f"text {i}") for i in range(30)] + [("k1", "text 1"), ("k2", "other")]
    random.Random(1).shuffle(rows)
    put = spark.createDataFrame(rows, "k string, text string").withColumn("h", F.md5("text"))
    keys = put.filter("k IS NULL OR k <> 'k3'").select("k", "h").distinct()
    if among:
        table.put(put, 0, among=keys, computed={"h": F.md5("text")})
    else:
        table.put(put, 0)
    read = table.read()
    assert exchanges(read) == []
    found = sorted(((r.k or ""), r.text, r.h) for r in read.collect())
    assert [k for k, _, _ in found] == sorted(("" if i == 0 else f"k{i}") for i in range(30) if not (among and i == 3))
    assert all((k or None, text) in rows for k, text, _ in found)
    assert read.filter("h <> md5(text) OR h IS NULL").count() == 0


def test_shuffles_go_with_their_job(spark, tmp_path):
    before = spark.conf.get(CLEANUP)
    with shuffles_let_go(spark):
        assert spark.conf.get(CLEANUP) == "true"
        spark.range(1000).repartition(4, "id").write.parquet(str(tmp_path / "a"))
    assert spark.conf.get(CLEANUP) == before
    with pytest.raises(ZeroDivisionError), shuffles_let_go(spark):
        1 / 0
    assert spark.conf.get(CLEANUP) == before


def test_survey_keeps_no_shuffle_of_an_ended_stage(spark, sf_dir, monkeypatch):
    """Stages are written with the setting that lets shuffles go, and verdicts without texts."""
    seen = []
    write = catalog.writers.write_stage
    monkeypatch.setattr(
        catalog.writers, "write_stage", lambda df, path: (seen.append((spark.conf.get(CLEANUP), df.columns)), write(df, path))
    )
    regions, checks = catalog._survey(spark, sf_dir)
    assert regions.collect() == regions.collect() != []
    assert checks.count() == 5 and spark.conf.get(CLEANUP) == "false"
    assert [on for on, _ in seen] == ["true", "true"]
    assert seen[0][1] == ["report_id", "content_hash", "status", "error"]
