import hashlib
import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from docfacts.operators import intake, synth
from docfacts.schemas import ATTEMPT, OCCURRENCE, REGISTRY
from docfacts.session import scratch_dir, scratch_root
from docfacts.sources import readers, writers
from docfacts.sources.keyed import KeyedTable
from docfacts.sources.prefixed import PrefixedTable
from docfacts.streaming import online, state

LONG = "a report text that is long enough"


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))


def content_hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def upload(report_id, text, n=0):
    return {"report_id": report_id, "text": text}


@pytest.mark.parametrize("watermark", [None, ("at", "1 hour")])
def test_stream_accepts_each_text_once_over_batches(spark, tmp_path, watermark):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = readers.stream_uploads(spark, str(source)).withColumn(
            "at", F.lit("2024-01-01 00:00:00").cast("timestamp")
        )
        online.intake_stream(stream, watermark).writeStream.format("parquet").option(
            "checkpointLocation", state
        ).trigger(availableNow=True).start(out).awaitTermination()
        return sorted(r.text for r in spark.read.parquet(out).collect())

    hot = [upload(f"R{i}", LONG) for i in range(40)]
    land(source, "1.json", [*hot, upload("S", "short"), "not json", upload("X", LONG + "!")])
    assert run() == [LONG, LONG + "!"]
    land(source, "2.json", [upload("B", LONG), upload("C", LONG + "?")])
    assert run() == [LONG, LONG + "!", LONG + "?"], "hashes of earlier batches are remembered"


def test_stream_verdicts_over_batches(spark, tmp_path):
    """Each run starts again from the checkpoint and knows the hashes of the runs before it."""
    source, out = tmp_path / "in", str(tmp_path / "verdicts")
    registry = spark.createDataFrame([(content_hash("known from an earlier run"),)], "content_hash string")

    def run():
        stream = readers.stream_uploads(spark, str(source)).withColumn("at", F.nullif(F.length("report_id"), F.lit(9)))
        found = state.verdicts(stream, ["at", "report_id"], registry)
        assert "text" not in found.columns
        query = online.land(found, out, str(tmp_path / "state"))
        query.awaitTermination()
        return {r.report_id: r.status for r in spark.read.parquet(out).collect()}, query.lastProgress

    hot = [upload(f"H{i:03}", LONG + " hot") for i in range(200)]
    random.Random(1).shuffle(hot)
    rows = [upload("A2", LONG), upload("A1", LONG), upload("A3", "short"), upload("nullorder", LONG + "n"), upload("B", LONG + "n")]
    land(source, "1.json", [*rows, *hot, upload("K", "known from an earlier run"), "not json"])
    found, _ = run()
    assert (found["A1"], found["A2"], found["A3"], found["K"]) == ("accepted", "duplicate", "rejected", "duplicate")
    assert (found["B"], found["nullorder"]) == ("accepted", "duplicate"), "a null order comes last"
    assert [k for k, v in found.items() if k and k[0] == "H" and v == "accepted"] == ["H000"] and len(found) == 207
    land(source, "2.json", [upload("A0", LONG), upload("C", LONG + "!"), upload("H", LONG + " hot")])
    found, progress = run()
    assert (found["A0"], found["C"], found["H"], len(found)) == ("duplicate", "accepted", "duplicate", 210)
    (operator,) = progress["stateOperators"]
    assert operator["numRowsUpdated"] == 1, "of the state, only the new hash is written"


def test_attempt_counters_and_admission_over_batches(spark, tmp_path):
    source = tmp_path / "in"
    totals = KeyedTable(spark, str(tmp_path / "totals"), ATTEMPT, "report_id")
    verdicts = str(tmp_path / "verdicts")
    schema = "report_id string, at long"

    def run():
        stream = lambda: spark.readStream.schema(schema).json(str(source))
        online.each_batch(
            online.attempts(stream()), online.put_batch(totals), str(tmp_path / "s1"), "update"
        ).awaitTermination()
        online.land(state.admissions(stream(), "at"), verdicts, str(tmp_path / "s2")).awaitTermination()
        rows = spark.read.parquet(verdicts).collect()
        return (
            dict(map(tuple, totals.read().collect())),
            sorted((r.report_id or "", r.at or 0, r.attempts, r.allowed) for r in rows),
        )

    land(source, "1.json", [{"report_id": "A", "at": 1}, {"report_id": "B", "at": 5}, {"at": 3}])
    counts, rows = run()
    assert counts == {"A": 1, "B": 1, None: 1}
    assert rows == [("", 3, 1, True), ("A", 1, 1, True), ("B", 5, 1, True)]
    land(source, "2.json", [{"report_id": "A", "at": 9}, {"report_id": "A", "at": 7}, {}, {"at": 4}])
    counts, rows = run()
    assert counts == {"A": 3, "B": 1, None: 3}
    assert [r for r in rows if r[0] == "A"] == [("A", 1, 1, True), ("A", 7, 2, True), ("A", 9, 3, False)]
    assert [r for r in rows if r[0] == ""] == [("", 0, 2, True), ("", 3, 1, True), ("", 4, 3, False)]


def test_idle_reports_are_let_go(spark, tmp_path):
    """A timer clears the counter of a report once the watermark is an hour past its last attempt."""
    source, out = tmp_path / "in", str(tmp_path / "out")

    def run(number, *attempts):
        land(source, f"{number}.json", [{"report_id": r, "at": f"2024-01-01T{at}:00Z"} for r, at in attempts])
        stream = spark.readStream.schema("report_id string, at timestamp").json(str(source))
        found = state.admissions(stream, "at", idle=("at", "0 seconds", 3600))
        online.land(found, out, str(tmp_path / "state")).awaitTermination()
        return {(r.report_id, r.at.hour): r.attempts for r in spark.read.parquet(out).collect()}

    run(1, ("A", "01:00"), ("B", "01:00"))
    run(2, ("B", "01:50"), ("C", "02:30"))
    run(3, ("C", "04:00"))
    found = run(4, ("A", "05:00"), ("C", "04:50"))
    assert found[("A", 5)] == 1, "A was idle for more than an hour and counts anew"
    assert found[("C", 4)] in (2, 3) and max(v for (r, _), v in found.items() if r == "C") == 3, "C was not"


def test_stream_upsert_over_batches(spark, tmp_path):
    source = tmp_path / "in"
    schema = spark.createDataFrame([], "report_id string, v long, x string").schema
    table = KeyedTable(spark, str(tmp_path / "table"), schema, "report_id", ["v"])

    def run():
        stream = spark.readStream.schema(schema).json(str(source))
        online.each_batch(stream, online.put_batch(table), str(tmp_path / "state")).awaitTermination()
        return sorted((r.report_id, r.x) for r in table.read().collect())

    row = lambda r, v, x: {"report_id": r, "v": v, "x": x}
    land(source, "1.json", [row("a", 1, "one"), row("a", 2, "two"), row("b", 1, "b")])
    assert run() == [("a", "two"), ("b", "b")]
    land(source, "2.json", [row("a", 3, "three"), row("b", 0, "late")])
    assert run() == [("a", "three"), ("b", "b")]


def test_prefixed_table(spark, tmp_path):
    """Many puts against a dictionary; what a read opens stays bounded, and a put can be repeated."""
    schema = spark.createDataFrame([], "k string, v long, x string").schema
    table = PrefixedTable(spark, str(tmp_path / "t"), schema, "k", ["v"], digits=1, fan_in=3)
    assert table.read().count() == 0 and table.lookup("k1").count() == 0
    rng, want = random.Random(3), {}
    for number in (0, 2, 3, 4, 6, 8, 9, 10, 12):
        rows = [(rng.choice([None, *(f"k{i}" for i in range(40))]), rng.randrange(5), f"{number}.{i}") for i in range(20)]
        rows = list({(k, v): (k, v, x) for k, v, x in rows}.values())
        df = spark.createDataFrame(rows, schema)
        if number in (4, 10):
            table.put(df.limit(3), number)  # a put that failed and is repeated
        table.put(df, number)
        for k, v, x in rows:
            if k not in want or v >= want[k][0]:
                want[k] = (v, x)
        folders = table._manifest()[1]
        assert max(len(f) for f in folders.values()) < 3 and len(folders) <= 16
        assert {r.k: (r.v, r.x) for r in table.read().collect()} == want
    found = table.lookup("k1", "k2", "absent")
    assert {r.k: (r.v, r.x) for r in found.collect()} == {k: want[k] for k in ("k1", "k2") if k in want}
    opened = {f.rsplit("_prefix=", 1)[1][0] for f in found.inputFiles()}
    assert opened <= {hashlib.md5(k.encode()).hexdigest()[0] for k in ("k1", "k2", "absent")}


def test_put_of_rows_named_by_their_keys(spark, tmp_path):
    """One row for each key named, also of rows that come twice or have no key; merged folders are read as they are."""
    schema = spark.createDataFrame([], "k string, text string, h string").schema
    table = PrefixedTable(spark, str(tmp_path / "t"), schema, "k", digits=1, fan_in=2)
    for number in range(2):
        rows = [(None if i == 0 else f"k{i}", f"text {i} {number}", f"h{i}") for i in range(40)]
        rows += [("k1", "other", "h-other"), *rows[:20]]
        named = [(k, h) for k, _, h in dict.fromkeys(rows[:30]) if number == 0 or k not in ("k2", "k3")]
        named.append(("absent", "h1"))
        table.put(spark.createDataFrame(rows, schema), number, among=spark.createDataFrame(named, "k string, h string"))
    want = {(None if i == 0 else f"k{i}", f"text {i} {int(i not in (2, 3))}", f"h{i}") for i in range(30)}
    read = table.read()
    assert read.count() == 30 and {tuple(r) for r in read.collect()} == want
    assert all(len(folders) == 1 for folders in table._manifest()[1].values())
    assert table.lookup("k1", "k35").collect() == [("k1", "text 1 1", "h1")]
    everything = {prefix: names for prefix, names in table._manifest()[1].items() if names[0].endswith("-merged")}
    assert "Exchange" not in table._current(everything)._jdf.queryExecution().executedPlan().toString()


def test_document_folders(spark, tmp_path):
    df = spark.createDataFrame([("a+b c/%d:é", "one"), ("d", "two\nlines")], "name string, text string")
    df.write.partitionBy("name").text(str(tmp_path / "docs"))
    read = readers.read_reports(spark, str(tmp_path / "docs"), folder="name")
    assert {(r.report_id, r.text) for r in read.collect()} == {("a+b c/%d:é", "one\n"), ("d", "two\nlines\n")}


def test_report_files_as_spark_writes_them(spark, tmp_path):
    """The same folders and texts as Spark's writer, with odd ids, none, and one that comes twice."""
    rows = [("a+b c/%d:é", "one"), ("d", "two\nlines"), ("d", "two\nlines"), (None, "none"), ("e", None), ("f", ""), ("x{y}[1]^", "z")]
    df = spark.createDataFrame(rows, "name string, text string").repartition(3)
    df.repartition(2, "name").write.partitionBy("name").text(str(tmp_path / "by spark"))
    writers.write_reports(df, str(tmp_path / "by tasks"), folder="name")
    folders = lambda at: sorted(p.name for p in (tmp_path / at).iterdir() if p.name.startswith("name="))
    texts = lambda at: sorted(readers.read_reports(spark, str(tmp_path / at), folder="name").collect())
    assert folders("by tasks") == folders("by spark") and texts("by tasks") == texts("by spark")
    assert not list((tmp_path / "by tasks").rglob("name=*/.*")), "neither checksums nor files half written"
    writers.write_reports(df.limit(0), str(tmp_path / "empty"), folder="name")
    assert texts("empty") == []


def test_report_files_are_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    """The driver has no name of a file; the same rows as Spark's reader, whose plan has all of them."""
    names = ["a", "50%25", "a+b", "%C3%A9", "é", "x y", "__HIVE_DEFAULT_PARTITION__", "=", ""]
    for name in (f"name={n}" for n in names):
        (tmp_path / name / "deep" / "name=b").mkdir(parents=True)
        (tmp_path / name / "part-0.txt").write_text(f"one of {name}")
        (tmp_path / name / "more.txt").write_bytes(b"bytes \xff of another kind")
        (tmp_path / name / "deep" / "name=b" / "low.txt").write_text("low")
        (tmp_path / name / "deep" / "no id.txt").write_text("none")
        for passed_over in ("empty.txt", ".hidden.txt", "_made.txt", "notes.md"):
            (tmp_path / name / passed_over).write_text("" if passed_over == "empty.txt" else "not read")
    for folder in ("_made", ".tmp"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.txt").write_text("not read")
    (tmp_path / "top.txt").write_text("top")
    both = lambda read: sorted((r.report_id, bytes(r.text)) for r in read.selectExpr("report_id", "CAST(text AS BINARY) AS text").collect())
    read = readers.read_reports(spark, f"file://{tmp_path}", folder="name")
    assert read.inputFiles() == []
    found = both(read)
    assert len(found) == 4 * len(names) + 1 and ("50%", b"one of name=50%25") in found and ("", b"top") in found
    monkeypatch.setattr(readers, "machine_path", lambda spark, path: None)
    by_spark = readers.read_reports(spark, str(tmp_path), folder="name")
    assert len(by_spark.inputFiles()) > 0 and both(by_spark) == found


def test_text_files(spark, tmp_path):
    (tmp_path / "RPT-001.txt").write_text("line one\n\nline two\n")
    (tmp_path / "RPT-002.txt").write_text("other")
    (tmp_path / "notes.md").write_text("ignored")
    rows = readers.read_reports(spark, str(tmp_path)).collect()
    assert {r.report_id: r.text for r in rows} == {
        "RPT-001": "line one\n\nline two\n", "RPT-002": "other",
    }


def test_uploads_with_unreadable_bodies(spark, tmp_path):
    land(tmp_path / "in", "u.json", [upload("A", LONG), "{broken", '"text"', '{"report_id": "B"}'])
    checked = intake.checked(readers.read_uploads(spark, str(tmp_path / "in"))).collect()
    assert [r.error for r in checked if r.report_id == "A"] == [None]
    assert sorted(r.error for r in checked if r.error) == [
        "body is not valid JSON", "body is not valid JSON", "text is required",
    ]


def test_labelled_array_file(spark, tmp_path):
    truth = {"mineral": "Gold", "depth_m": 30, "lat": -22.5, "lon": -68.0, "grade_g_t": 1.5, "hole_id": "DH-1"}
    (tmp_path / "truth.json").write_text(
        json.dumps([{"report_id": "R", "text": "t", "ground_truth": truth}], indent=2)
    )
    row = readers.flat_truth(readers.read_labelled(spark, str(tmp_path / "truth.json"))).first()
    assert row.asDict() == {"report_id": "R", "text": "t", **truth}


def test_stored_numbers_arrive_as_text(spark, tmp_path):
    item = {"report_id": {"S": "A"}, "mineral": {"S": "Gold"}, "depth_m": {"N": "100.0"}, "lat": {"N": "-22.5"},
            "lon": {"N": "-68.123"}, "grade_g_t": {"N": "2"}, "hole_id": {"S": "DH-A"}}
    land(tmp_path / "in", "x.json", [item])
    row = readers.read_stored(spark, str(tmp_path / "in")).first()
    assert tuple(row) == ("A", "Gold", 100.0, -22.5, -68.123, 2.0, "DH-A")
    written = json.loads(writers.wrap_stored(spark.createDataFrame([row])).toJSON().first())
    assert written["lon"] == {"N": "-68.123"} and written["hole_id"] == {"S": "DH-A"}


def test_views(spark, tmp_path):
    empty = readers.view(spark, str(tmp_path / "absent"), "absent_occurrences")
    assert empty.schema == OCCURRENCE and empty.count() == 0
    assert spark.sql("SELECT * FROM absent_occurrences ORDER BY n_reports DESC").count() == 0
    spark.range(3).write.parquet(str(tmp_path / "deep" / "er" / "a"))
    spark.range(3).write.parquet(str(tmp_path / "deep" / "er" / "b"))
    schema = spark.range(1).schema
    assert readers.view(spark, str(tmp_path / "deep"), "deep", schema, nested=True).count() == 6


def test_occurrence_search_prunes_folders(spark, tmp_path):
    records = spark.createDataFrame(
        [("a", "Gold", 1.0, -22.0, -68.0, 1.0, "h"), ("b", "Zinc", 1.0, -22.0, -68.0, 1.0, "h")],
        "report_id string, mineral string, depth_m double, lat double, lon double, grade_g_t double, hole_id string",
    )
    writers.write_occurrences(records, str(tmp_path))
    served = readers.view(spark, str(tmp_path / "occurrences"), "served").filter("mineral = 'Gold'")
    assert [r.n_reports for r in served.collect()] == [1]
    assert sorted(r.report_id for r in spark.read.parquet(str(tmp_path / "links")).collect()) == ["a", "b"]
    plan = served._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Gold" in plan.split("PartitionFilters")[1]


def test_scratch_follows_the_session_setting(spark):
    root = spark.sparkContext.getCheckpointDir()
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b
    assert root is None or a.startswith(root.rsplit("/", 1)[0].replace("file:", "")) or root in a


def test_scratch_is_never_local_to_a_machine_of_a_cluster():
    assert scratch_root("file:/w", "local[4]") == "file:/w/scratch"
    assert scratch_root("hdfs://n/w/", "yarn") == "hdfs://n/w/scratch"
    for warehouse in ("file:/w", "/w"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_root(warehouse, "spark://host:7077")


def test_generated_reports(spark):
    a = synth.reports(spark, 300, seed=42)
    rows = {r.report_id: r for r in a.collect()}
    assert len(rows) == 300 and "RPT-000" in rows and "RPT-299" in rows
    again = {r.report_id: r for r in synth.reports(spark, 300, seed=42).repartition(5).collect()}
    assert rows == again
    assert rows != {r.report_id: r for r in synth.reports(spark, 300, seed=43).collect()}
    for r in rows.values():
        t = r.ground_truth
        assert 20 <= t.depth_m <= 400 and -25 <= t.lat <= -20 and -70 <= t.lon <= -66
        assert 0.1 <= t.grade_g_t <= 5.0 and 1 <= int(t.hole_id[3:]) <= 99
        for value in (t.mineral, f"{t.depth_m}m", str(t.lat), str(t.lon), str(t.grade_g_t), t.hole_id):
            assert value in r.text
    assert len({r.ground_truth.mineral for r in rows.values()}) == 6


def test_skewed_picks(spark):
    items = [f"item-{i}" for i in range(100)]
    df = synth.skewed(spark.range(5000), items)
    share = df.filter(F.col("item").isin(items[:5])).count() / 5000
    assert abs(share - 0.6) <= 0.05
    assert df.select("item").distinct().count() > 90
    assert df.collect() == synth.skewed(spark.range(5000), items).collect()
    only = synth.skewed(spark.range(20), ["only"]).select("item").distinct().collect()
    assert [r.item for r in only] == ["only"]


def test_attempts_are_numbered_row_by_row():
    """A frame for each report cost more than its few attempts; null comes first, ties as they came."""

    class Counter:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    counter = state._Counter(["at"], 2, None)
    counter.used = Counter()
    rows = [Row(event=e, at=at) for e, at in (("a", 5), ("b", None), ("c", 5), ("d", 1))]
    found = list(counter.handleInputRows(("A",), iter(rows), None))
    assert [(r.event, r.attempts, r.allowed) for r in found] == [("b", 1, True), ("d", 2, True), ("a", 3, False), ("c", 4, False)]
    again = counter.handleInputRows(("A",), iter([Row(event="e", at=0)]), None)
    assert [r.attempts for r in again] == [5] and counter.used.value == (5,)
