"""Every registered query against its SQL on the given tables."""

import subprocess
import sys

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, difference

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("absent", ["docfacts.llm", "corpus_pipeline", "zstandard"])
def test_other_queries_do_without_those_for_training_data(absent):
    code = f"""
import sys
sys.modules[{absent!r}] = None
import __spark_entry__ as entry
names = entry.queries()
assert "intake_status" in names and "pipeline" not in names and not any(n.startswith("op") for n in names)
assert set(entry.oracle_sql()) <= set(names)
"""
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], check=True, timeout=120)
