from docfacts.operators import intake
from docfacts.schemas import REGISTRY
from docfacts.sources.keyed import KeyedTable

LONG = "a report text that is long enough"


def gated(spark, rows, registry=None):
    df = spark.createDataFrame(rows, "arrival long, report_id string, text string")
    out = intake.gate(df, "arrival", registry)
    return {r.arrival: r for r in out.collect()}


def test_new_duplicate_and_short(spark):
    out = gated(spark, [(1, "A", LONG), (2, "B", LONG), (3, "C", "too short")])
    assert [out[i].status for i in (1, 2, 3)] == ["accepted", "duplicate", "rejected"]
    assert out[2].content_hash == out[1].content_hash, "the hash is returned for duplicates"
    assert out[3].content_hash is None and "too short" in out[3].error


def test_missing_fields_are_rejected(spark):
    out = gated(spark, [(1, None, LONG), (2, "", LONG), (3, "C", None), (4, "D", "")])
    assert {r.status for r in out.values()} == {"rejected"}
    assert out[1].error == "report_id is required" and out[3].error == "text is required"


def test_limit_counts_bytes(spark):
    out = gated(spark, [(1, "A", "é" * 10), (2, "B", "x" * 19), (3, "C", "x" * 20)])
    assert [out[i].status for i in (1, 2, 3)] == ["accepted", "rejected", "accepted"]


def test_hash_is_sha256_of_raw_text(spark):
    import hashlib

    out = gated(spark, [(1, "A", LONG + " é\n")])
    assert out[1].content_hash == hashlib.sha256((LONG + " é\n").encode()).hexdigest()


def test_first_arrival_wins_however_rows_lie(spark):
    rows = [(i, f"R{i}", LONG) for i in range(50, 0, -1)]
    out = gated(spark, rows)
    assert [i for i, r in out.items() if r.status == "accepted"] == [1]


def test_registry_of_earlier_runs(spark):
    first = gated(spark, [(1, "A", LONG)])[1]
    registry = spark.createDataFrame([(first.content_hash, "A")], REGISTRY)
    out = gated(spark, [(5, "B", LONG), (6, "C", LONG + "!")], registry)
    assert [out[5].status, out[6].status] == ["duplicate", "accepted"]


def test_several_order_columns(spark):
    df = spark.createDataFrame(
        [("d2", 1, "A", LONG), ("d1", 2, "B", LONG)],
        "day string, seq long, report_id string, text string",
    )
    out = {r.report_id: r.status for r in intake.gate(df, ["day", "seq"]).collect()}
    assert out == {"A": "duplicate", "B": "accepted"}


def test_hot_text_and_statuses_add_up(spark):
    """A third of all uploads carry one text."""
    df = spark.range(3000).selectExpr(
        "id AS arrival",
        "concat('R', id) AS report_id",
        f"IF(id % 3 = 0, '{LONG}', concat('{LONG} number ', id)) AS text",
    )
    counts = {r.status: r.n_uploads for r in intake.summary(intake.gate(df, "arrival")).collect()}
    assert counts == {"accepted": 2001, "duplicate": 999}


def test_documents_are_upserted_by_report(spark, tmp_path):
    table = KeyedTable(
        spark, str(tmp_path / "docs"), spark.createDataFrame([], "report_id string, text string").schema,
        "report_id",
    )
    assert table.read().count() == 0
    table.put(spark.createDataFrame([("A", "one"), ("B", "b")], table.schema), 0)
    table.put(spark.createDataFrame([("A", "two")], table.schema), 1)
    table.put(spark.createDataFrame([("A", "two")], table.schema), 1)  # a repeated batch
    assert sorted(map(tuple, table.read().collect())) == [("A", "two"), ("B", "b")]
    assert sorted(map(tuple, table.read(before=1).collect())) == [("A", "one"), ("B", "b")]
    small = table.compact(str(tmp_path / "compacted"))
    assert small.history().count() == 2
