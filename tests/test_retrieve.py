import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docfacts.operators import retrieve
from docfacts.operators.chunk import chunk
from docfacts.functions import vectors
from docfacts.plans import derived
from docfacts.session import scratch_dir
from docfacts.sources.vector_index import VectorIndex


def vector_rows(n=200, dims=6, seed=1):
    """A third of all vectors belong to one report."""
    rng = random.Random(seed)
    return [
        (f"v{i:03d}", "hot" if i % 3 == 0 else f"r{i % 11}", i, [rng.uniform(-1, 1) for _ in range(dims)])
        for i in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "id string, report_id string, chunk_index int, embedding array<float>"
    )


def l2(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def cosine(a, b):
    norm = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(y * y for y in b))
    return 1 - (sum(x * y for x, y in zip(a, b)) / norm if norm else 0.0)


@pytest.mark.parametrize("metric, measure", [("l2", l2), ("cosine", cosine)])
def test_top_k_equals_brute_force(spark, metric, measure):
    rows = vector_rows()
    query = [0.1, -0.2, 0.3, 0.0, 0.5, -0.4]
    df = frame(spark, rows)
    stored = {r.id: r.embedding for r in df.collect()}
    order = lambda r: (measure(stored[r[0]], query), r[0])

    got = [r.id for r in retrieve.top_k(df, query, metric=metric).collect()]
    assert got == [r[0] for r in sorted(rows, key=order)[:5]], "five by default"

    where = retrieve.top_k(df, query, 3, where={"report_id": "r4"}, metric=metric).collect()
    assert [r.id for r in where] == [r[0] for r in sorted(rows, key=order) if r[1] == "r4"][:3]

    scoped = retrieve.top_k(df, query, 4, scope="report_id", metric=metric).collect()
    for report in {r[1] for r in rows}:
        expected = [r[0] for r in sorted(rows, key=order) if r[1] == report][:4]
        assert [r.id for r in sorted(scoped, key=lambda r: r.rank) if r.report_id == report] == expected


def test_scoped_is_not_global_then_filtered(spark):
    df = frame(spark, [("a", "A", 0, [0.0]), ("b", "A", 1, [0.1]), ("c", "B", 0, [9.0])])
    everywhere = retrieve.top_k(df, [0.0], 2).filter("report_id = 'B'").count()
    assert everywhere == 0 and retrieve.top_k(df, [0.0], 2, scope="report_id").filter("report_id = 'B'").count() == 1


def test_column_and_list_queries_agree(spark):
    df = frame(spark, vector_rows(30))
    query = [0.3, 0.1, -0.7, 0.2, 0.0, 0.9]
    as_column = F.array(*[F.lit(x) for x in query])
    for metric in vectors.METRICS:
        row = df.agg(
            F.max(
                F.abs(
                    vectors.distance(F.col("embedding"), query, metric)
                    - vectors.distance(F.col("embedding"), as_column, metric)
                )
            ).alias("gap")
        ).first()
        assert row.gap < 1e-12
    zero = spark.createDataFrame([([0.0, 0.0],)], "v array<double>")
    assert zero.select(vectors.cosine_distance(F.col("v"), [1.0, 0.0]).alias("d")).first().d == 1.0
    with pytest.raises(ValueError, match="unknown metric"):
        vectors.distance(F.col("v"), [1.0], "nearest")


@pytest.mark.parametrize("n", [1, 64, 300])
def test_one_formula_at_any_length(spark, n):
    df = spark.createDataFrame([([1.0] * n,), (None,)], "v array<double>")
    for metric, want in (("l2", float(n)), ("cosine", 1.0)):
        found = df.select(vectors.distance(F.col("v"), [0.0] * n, metric).alias("d")).collect()
        assert [r.d for r in found] == [want, None]


@pytest.mark.parametrize("n", [1, 3])
def test_other_lengths_are_refused(spark, n):
    df = spark.createDataFrame([("a", [1.0] * n)], "id string, embedding array<double>")
    for metric in ("l2", "cosine"):
        with pytest.raises(Exception, match=f"vector of {n} dimensions, expected 2"):
            retrieve.top_k(df, [0.0, 0.0], metric=metric).collect()


def test_absent_vectors_are_not_ranked(spark):
    df = spark.createDataFrame([("a", None), ("b", [5.0]), ("c", [1.0])], "id string, embedding array<double>")
    assert [r.id for r in retrieve.top_k(df, [0.0], 3).collect()] == ["c", "b"]


def test_context_in_text_order_with_fallback(spark):
    reports = spark.createDataFrame(
        [("A", "One. Two. Three. Four. Five. Six."), ("B", "Never indexed. At all.")],
        "report_id string, text string",
    )
    hits = spark.createDataFrame(
        [("A", 5), ("A", 0), ("A", 2), ("A", 99)], "report_id string, chunk_index int"
    )
    out = {r.report_id: r.context for r in retrieve.context(reports, hits).collect()}
    assert out == {"A": "One. Three. Six.", "B": "Never indexed. At all."}


def test_term_encoder(spark):
    texts = ["Drill hole depth and assay grade.", "Nothing of interest here.", "...", "Drill depth"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    encoder = retrieve.TermEncoder(64).fit(df)
    rows = {r.n: r.embedding for r in retrieve.embed(df.repartition(3), encoder).collect()}
    assert {n: len(v) for n, v in rows.items()} == dict.fromkeys(range(4), 64)
    norms = {n: round(math.sqrt(sum(x * x for x in v)), 3) for n, v in rows.items()}
    assert norms == {0: 1.0, 1: 1.0, 2: 0.0, 3: 1.0}
    assert all((x * 2**14).is_integer() for v in rows.values() for x in v)
    again = {r.n: r.embedding for r in retrieve.embed(df.coalesce(1), encoder).collect()}
    assert rows == again
    query = retrieve.encode_query(df, encoder)
    assert l2(rows[0], query) < l2(rows[1], query)


def test_batch_encoder_loads_once_per_task(spark):
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)
        return lambda texts: [[len(t), t.count("e")] for t in texts]

    df = spark.createDataFrame([("a", "bee"), ("b", "x")], "id string, text string").coalesce(1)
    out = {r.id: r.embedding for r in retrieve.embed(df, retrieve.BatchEncoder(load)).collect()}
    assert out == {"a": [3.0, 2.0], "b": [1.0, 0.0]} and loads.value == 1


def test_retrieval_finds_the_fact_sentences(spark):
    facts = "Drill hole DH-1 hit mineral grade. Coordinates of the occurrence at depth. "
    filler = " ".join(f"Weather was fine on day {w}." for w in ("one", "two", "three", "four", "five"))
    reports = spark.createDataFrame([("A", facts + filler)], "report_id string, text string")
    encoder = retrieve.TermEncoder().fit(chunk(reports))
    query = retrieve.encode_query(reports, encoder)
    row = retrieve.retrieve(reports, encoder, query).first()
    assert row.context.startswith("Drill hole DH-1 hit mineral grade. Coordinates of the occurrence at depth.")
    assert row.context.count(".") == 4


@pytest.mark.parametrize("dims", [1, 7, 256])
def test_term_encoder_by_brute_force(spark, dims):
    rng = random.Random(dims)
    words = ["depth", "Gold", "ÉTÉ", "x1", "été", "鉱物", "drill", "of", "the", "2.5"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(30)] + ["", None, "the " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    encoder = retrieve.TermEncoder(dims).fit(df)

    def draws(text):
        for word in re.findall(r"[^\W_]+", (text or "").lower()):
            digits = hashlib.md5(word.encode()).hexdigest()
            yield int(digits[:8], 16) % dims, -1 if digits[8] >= "8" else 1

    used = [{d for d, _ in draws(t)} for t in texts]
    weights = [math.floor(1000 * math.log((len(texts) + 1) / (sum(d in u for u in used) + 1)) + 0.5) for d in range(dims)]
    assert encoder.weights == weights
    for row in encoder.encode(df).collect():
        values = [0] * dims
        for d, sign in draws(texts[row.n]):
            values[d] += sign * weights[d]
        length = math.sqrt(sum(v * v for v in values))
        want = [math.copysign(math.floor(abs(v) * 2**14 / length + 0.5), v) / 2**14 if length else 0.0 for v in values]
        assert row.embedding == want


def test_many_of_a_hot_scope(spark):
    """k above Spark's limit on ranks: a scope is dealt out, and nothing is lost in merging."""
    df = spark.range(9000).selectExpr(
        "concat('v', id) AS id", "IF(id % 3 = 0, 'hot', concat('s', id % 40)) AS report_id",
        "array(CAST((id * 7919) % 1000 AS double)) AS embedding",
    )
    scopes = {}
    for r in df.collect():
        scopes.setdefault(r.report_id, []).append((r.embedding[0] ** 2, r.id))
    found = retrieve.top_k(df, [0.0], 2000, scope="report_id")
    got = {}
    for r in found.orderBy("rank").collect():
        got.setdefault(r.report_id, []).append((r.distance, r.id))
    assert got == {scope: sorted(rows)[:2000] for scope, rows in scopes.items()}
    assert "_share" in found._jdf.queryExecution().toString()
    assert "_share" not in retrieve.top_k(df, [0.0], 20, scope="report_id")._jdf.queryExecution().toString()


def clustered(n=6000, dims=8, seed=5):
    """Vectors about 30 centres; a third about one of them, and some that are null."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dims)) * 3
    at = np.where(np.arange(n) % 3 == 0, 0, rng.integers(0, 30, n))
    return (centres[at] + rng.normal(size=(n, dims))).tolist()


def test_vector_index(spark):
    given = clustered()
    rows = [(f"v{i}", i % 4, v) for i, v in enumerate(given)] + [("none", 0, None)]
    df = spark.createDataFrame(rows, "id string, kind int, embedding array<double>")
    index = VectorIndex(spark, scratch_dir(spark, "test-index")).build(df, lists=24, sample=2000)
    assert sorted(r.id for r in spark.read.parquet(f"{index.path}/lists").collect()) == sorted(r[0] for r in rows if r[2])
    plan = index.candidates(given[0], 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list#" in plan and index.candidates(given[0], 3).count() < len(given)
    rng, found, wanted = np.random.default_rng(1), 0, 0
    stored = np.array(given)
    for i in rng.integers(0, len(given), 12):
        query = (stored[i] + rng.normal(size=8) * 0.3).tolist()
        near = np.argsort(((stored - query) ** 2).sum(axis=1), kind="stable")[:10]
        exact = {f"v{j}" for j in near}
        found += len(exact & {r.id for r in index.search(query, 10, probes=6).collect()})
        wanted += 10
        if not wanted % 60:
            everything = index.search(query, 10, probes=24).collect()
            assert {r.id for r in everything} == exact and "list" not in everything[0]
            assert everything == retrieve.top_k(df, query, 10).select(everything[0].__fields__).collect()
    assert found >= 0.9 * wanted
    assert {r.kind for r in index.search(given[0], 5, where={"kind": 2}).collect()} == {2}


def test_distance_by_batches_is_that_of_the_expression(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-9, 9) for _ in range(5)]) for i in range(40)]
    rows += [(40, None), (41, [1.0, None, 2.0, 3.0, 4.0]), (42, [float("nan")] * 5), (43, [-0.0] * 5)]
    df = spark.createDataFrame(rows, "n int, embedding array<double>").coalesce(1)
    query = [0.1, -0.7, 3.3, 0.0, 2.5]
    pairs = df.select(
        vectors.squared_l2(F.col("embedding"), query).alias("a"),
        vectors.squared_l2_by_batches(F.col("embedding"), query).alias("b"),
    ).collect()
    assert [repr(r.a) for r in pairs] == [repr(r.b) for r in pairs] and pairs[41].b is None


def test_encoding_and_ranking_share_one_python_pass(spark):
    """The interpreted lambdas over 256 components per passage were most of the time."""
    reports = spark.createDataFrame([("A", "One gold. Two gold.")], "report_id string, text string")
    encoder = retrieve.TermEncoder(16).fit(chunk(reports))
    hits = retrieve.top_k(retrieve.embed(chunk(reports), encoder), [0.0] * 16, 1, scope="report_id", tie_break="chunk_index")
    plan = hits.select("id", "rank")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "lambdafunction" not in plan


def test_keys_of_one_small_file_are_dealt_out(spark, tmp_path):
    spark.range(90).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey").coalesce(1).write.parquet(f"{tmp_path}/orders")
    orders = spark.read.parquet(f"{tmp_path}/orders")
    spread = derived.spread(orders)
    assert spread.rdd.getNumPartitions() > orders.rdd.getNumPartitions() == 1
    assert sorted(spread.collect()) == sorted(orders.collect())
