import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docfacts.functions import text
from docfacts.operators.chunk import chunk, with_metadata
from docfacts.operators.parse import parse_outputs, stated_facts
from pyspark.sql import functions as F


def expected_passages(document: str) -> list[str]:
    """Brute force: cut at whitespace that follows a full stop or a line break."""
    pieces, start, i = [], 0, 1
    while i < len(document):
        if document[i - 1] in ".\n" and document[i].isspace():
            pieces.append(document[start:i])
            while i < len(document) and document[i].isspace():
                i += 1
            start = i
        i += 1
    pieces.append(document[start:])
    return [p.strip() for p in pieces if p.strip()]


def chunks_of(spark, documents):
    df = spark.createDataFrame([(str(i), d) for i, d in enumerate(documents)], "report_id string, text string")
    found = {str(i): [] for i in range(len(documents))}
    for row in chunk(df).orderBy("report_id", "chunk_index").collect():
        assert row.id == f"{row.report_id}-chunk-{row.chunk_index}"
        assert row.chunk_index == len(found[row.report_id])
        found[row.report_id].append(row.text)
    return list(found.values())


CASES = [
    "One. Two.\n\nThree", "Field\nnotes stay whole", ".\nA", "a\n\nb", "at 1.19 percent. Yes",
    "no-break. Space", "sep.\x1cchar", "  lead. trail.  ", "", " \n ", "a \n \n b", "\n\nA. ",
    "ideographic.　space", "zero​width. x",
]


def test_chunks_equal_brute_force(spark):
    assert chunks_of(spark, CASES) == [expected_passages(c) for c in CASES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab.\n \t \x1d", max_size=40), min_size=20, max_size=40))
def test_chunks_of_any_text(spark, documents):
    assert chunks_of(spark, documents) == [expected_passages(d) for d in documents]


def test_chunk_metadata(spark):
    df = spark.createDataFrame([("R", "A. B")], "report_id string, text string")
    rows = with_metadata(chunk(df)).orderBy("id").collect()
    assert [r.metadata.asDict() for r in rows] == [
        {"report_id": "R", "chunk_index": 0}, {"report_id": "R", "chunk_index": 1},
    ]


def test_prompt_and_hint(spark):
    row = spark.range(1).select(
        text.prompt(F.lit("REPORT"), F.lit("")).alias("plain"),
        text.prompt(F.lit("REPORT"), text.retry_hint(F.lit("bad depth"))).alias("hinted"),
    ).first()
    assert "Note:" not in row.plain and "\nReport:\nREPORT\n\nReturn only" in row.plain
    assert "Note: A previous extraction attempt failed validation: bad depth. Be precise" in row.hinted


FULL = '"mineral": "Gold", "depth_m": 100, "lat": -22.5, "lon": -68, "grade_g_t": 2, "hole_id": "DH-1"'


def parsed(spark, output):
    df = spark.createDataFrame([(output,)], "output string")
    row = parse_outputs(df, "output").first()
    return (row.record.asDict() if row.record else None), [(e.field, e.message) for e in row.type_errors]


def test_noisy_output(spark):
    record, errors = parsed(
        spark, "<think>{draft}</think>Here:\n```json\n{" + FULL + "}\n```\nAnything else?"
    )
    assert record == {
        "mineral": "Gold", "depth_m": 100.0, "lat": -22.5, "lon": -68.0, "grade_g_t": 2.0,
        "hole_id": "DH-1",
    }
    assert errors == []


def test_partial_object_reports_missing_fields(spark):
    record, errors = parsed(spark, 'Sure:\n```json\n{"mineral": "Gold", "depth_m": 100}\n```\n')
    assert record["mineral"] == "Gold" and record["depth_m"] == 100.0 and record["lat"] is None
    assert errors == [(f, f"{f}: field required") for f in ("lat", "lon", "grade_g_t", "hole_id")]


@pytest.mark.parametrize(
    "value, expected",
    [('"77"', 77.0), ('" 77 "', 77.0), ("true", 1.0), ('"77m"', None), ('"77d"', None),
     ("null", None), ('"1_000"', 1000.0), ('"-1e3"', -1000.0), ('"true"', None), ("[1]", None),
     ("{}", None), ("0.1", 0.1), ("1e400", float("inf"))],
)
def test_number_coercion(spark, value, expected):
    record, errors = parsed(spark, "{" + FULL.replace("100", value) + "}")
    assert record["depth_m"] == expected
    assert bool(errors) == (expected is None)


@pytest.mark.parametrize("value", ["7", "null", "true", '["x"]'])
def test_a_text_must_be_a_text(spark, value):
    record, errors = parsed(spark, "{" + FULL.replace('"DH-1"', value) + "}")
    assert record["hole_id"] is None and errors[0][0] == "hole_id"


@pytest.mark.parametrize("output", ["nothing here", '{"mineral" "Gold"}', "{} {}", "{}, {}", "{}], [{}", "", "}{"])
def test_outputs_without_an_object(spark, output):
    record, errors = parsed(spark, output)
    assert record is None and errors[0][0] == "output"
    if not re.search(r"\{.*\}", output, re.S):
        assert "no JSON object found" in errors[0][1]


def test_extra_keys_are_ignored(spark):
    assert parsed(spark, '{"note": {"a": [1]}, ' + FULL + "}")[1] == []


def test_stated_facts(spark):
    report = (
        "HEAD\n\nDrill hole DH-9 intersected 1.25 g/t Zinc at a depth of 77m. "
        "Coordinates recorded at the collar: -22.5, -68.123.\n\nNotes."
    )
    df = spark.createDataFrame([("A", report), ("B", "nothing")], "report_id string, text string")
    a, b = stated_facts(df).orderBy("report_id").collect()
    assert tuple(a)[2:] == ("Zinc", 77.0, -22.5, -68.123, 1.25, "DH-9")
    assert tuple(b)[2:] == (None,) * 6
